"""Chat formatting: turns checked by a state machine, rendered by a declarative template.

The template gives each role the text before and after a turn and whether the turn is
trained on. Its control strings, where a text holds them, are escaped so that reading the
output back gives the text as it was. Rows come in segments of text with a loss flag.

Null text counts as empty, a null role as the role ''. Roles that the template lacks are
rendered with its ``other`` entry. Turns with equal numbers are ordered by role and text; a
repeated row is a turn of its own. A null conversation id is one conversation. Turns in a
wrong order are formatted all the same and marked by ``order_ok``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import table


@dataclass(frozen=True)
class Role:
    prefix: str
    suffix: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How turns are rendered and which orders are right.

    ``end`` closes every turn, also the last. ``moves`` are the pairs of state and role that
    the state machine takes; after a turn its role is the state. ``accepts`` are the states
    in which a conversation may end.
    """

    roles: dict[str, Role]
    other: Role
    end: str
    controls: tuple[str, ...]
    moves: frozenset[tuple[str, str]]
    accepts: frozenset[str]
    start: str = "start"
    escapes: dict[str, str] = field(default_factory=lambda: {"<": "&#60;", "[": "&#91;"})


INSTRUCT = Template(
    roles={
        "system": Role("[SYS] ", " [/SYS]"),
        "user": Role("[INST] ", " [/INST]"),
        "assistant": Role("[OUT] ", "", loss=True),
    },
    other=Role("[TURN] ", " [/TURN]"),
    end="</s>",
    controls=(
        "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[OUT]", "[TURN]", "[/TURN]"
    ),
    moves=frozenset(
        {
            ("start", "system"),
            ("start", "user"),
            ("system", "user"),
            ("user", "assistant"),
            ("assistant", "user"),
        }
    ),
    accepts=frozenset({"assistant"}),
)


def escape(text: Column, template: Template = INSTRUCT) -> Column:
    """Break every control string: its first character becomes a reference like ``&#60;``."""
    out = F.replace(text, F.lit("&#"), F.lit("&#38;#"))
    for control in template.controls:
        broken = template.escapes[control[0]] + control[1:]
        out = F.replace(out, F.lit(control), F.lit(broken))
    return out


def unescape(text: Column, template: Template = INSTRUCT) -> Column:
    out = text
    for char, reference in template.escapes.items():
        out = F.replace(out, F.lit(reference), F.lit(char))
    return F.replace(out, F.lit("&#38;#"), F.lit("&#"))


def turns_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def segments(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, turn, role, move_ok, parts): what each turn puts out, still one row per turn.

    ``parts`` are (text, loss) in order. ``move_ok`` is whether the state machine takes this
    turn after the one before; it needs the role before alone, so a conversation of any
    length streams through the window.
    """
    turns = turns_of(rows)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    state = F.coalesce(F.lag("role").over(order), F.lit(template.start))
    moves = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in sorted(template.moves)])
    role, text = F.col("role"), escape(F.col("text"), template)
    # A role that the template lacks is named in the text: escaped, on a line of its own.
    named = F.concat(
        F.replace(escape(role, template), F.lit("\n"), F.lit("&#10;")), F.lit("\n"), text
    )

    def part(value: Column, loss: bool) -> Column:
        return F.struct(value.alias("text"), F.lit(loss).alias("loss"))

    def render(kind: Role, body: Column) -> Column:
        return F.array(
            part(F.lit(kind.prefix), False), part(body, kind.loss), part(F.lit(kind.suffix + template.end), False)
        )

    known = reduce(
        lambda made, item: made.when(role == item[0], render(item[1], text)), template.roles.items(), F
    )
    return turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.array_contains(moves, F.array(state, role)).alias("move_ok"),
        known.otherwise(render(template.other, named)).alias("parts"),
    )


def conversations(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, order_ok, parts, formatted): each conversation as one sample.

    A sample is one value, so a conversation has to fit into a row here; ``segments`` has
    no such bound.
    """
    made = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "move_ok", "parts")))
    each = segments(rows, template).groupBy("conv_id").agg(made.alias("turns"))
    last = F.element_at("turns", -1)["role"]
    ends = F.array(*[F.lit(x) for x in sorted(template.accepts)])
    parts = F.flatten(F.transform("turns", lambda t: t["parts"]))
    return each.select(
        "conv_id",
        (F.forall("turns", lambda t: t["move_ok"]) & F.array_contains(ends, last)).alias("order_ok"),
        parts.alias("parts"),
    ).withColumn("formatted", F.array_join(F.transform("parts", lambda p: p["text"]), ""))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns in a formatted conversation as (role, text), unescaped."""
    pieces = F.split(formatted, _literal(template.end))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def body(piece: Column, kind: Role) -> Column:
        n = F.length(piece) - len(kind.prefix) - len(kind.suffix)
        return F.substring(piece, F.lit(len(kind.prefix) + 1), n)

    def turn(piece: Column) -> Column:
        def known(name: str, kind: Role) -> Column:
            text = unescape(body(piece, kind), template)
            return F.struct(F.lit(name).alias("role"), text.alias("text"))

        rest = body(piece, template.other)
        head = F.substring_index(rest, "\n", 1)
        name = unescape(F.replace(head, F.lit("&#10;"), F.lit("\n")), template)
        tail = F.substring(rest, F.length(head) + 2, F.length(rest))
        other = F.struct(name.alias("role"), unescape(tail, template).alias("text"))
        out = F
        for role, kind in template.roles.items():
            out = out.when(piece.startswith(kind.prefix), known(role, kind))
        return out.otherwise(other)

    return F.transform(pieces, turn)


def _literal(text: str) -> str:
    return "".join(f"[{c}]" if c not in "^\\" else f"\\{c}" for c in text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, read back from the output."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = turns_of(table(spark, sf_dir, "conversations")).unionByName(extra)
    made = conversations(rows)
    back = made.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "loss_text",
        F.array_join(
            F.transform(F.filter("parts", lambda p: p["loss"]), lambda p: unescape(p["text"])), ""
        ),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "order_ok",
    )


def _sql_escaped() -> str:
    out = "replace(text, '&#', '&#38;#')"
    for control in INSTRUCT.controls:
        out = f"replace({out}, '{control}', '{INSTRUCT.escapes[control[0]] + control[1:]}')"
    return out


def _sql_frame() -> str:
    known = " ".join(
        f"WHEN '{name}' THEN {len(kind.prefix + kind.suffix + INSTRUCT.end)}"
        for name, kind in INSTRUCT.roles.items()
    )
    return f"CASE role {known} END"


_MOVES = ", ".join(f"'{a}>{b}'" for a, b in sorted(INSTRUCT.moves))

ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
n AS (
  SELECT *, row_number() OVER w AS place,
         concat(coalesce(lag(role) OVER w, 'start'), '>', role) IN ({_MOVES}) AS move_ok
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_sql_frame()} + length({_sql_escaped()})) AS BIGINT) AS formatted_chars,
  bool_and(move_ok) AND max_by(role, place) = 'assistant' AS order_ok
FROM n GROUP BY conv_id"""

QUERIES = {"op5_chat_format": query}
ORACLES = {"op5_chat_format": ORACLE}
