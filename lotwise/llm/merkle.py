"""Document fingerprints: Merkle trees over sections, paragraphs and blocks of words.

A section ends at an empty line, a paragraph at a line feed; the leaves are blocks of up to
four words of a paragraph. A paragraph's hash covers those of its blocks, a section's those
of its paragraphs, the root those of its sections, each by whole 128-bit hashes. A
fingerprint is the tree as text, hashes below the root cut short:
``root:section=paragraph,block,block;paragraph,..|section=..``. Equal texts have equal
roots and fingerprints and unequal texts unequal roots; unequal branches show where texts
differ. The likeness of two fingerprints is the share of their leaves that both have.

Null text counts as empty and has a tree without leaves. Repeated rows each give a row. A long
text has a long fingerprint; its tree is made in the row. Other columns are not looked at.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import table, texts

#: Pieces of a paragraph: up to four runs of up to 64 visible characters each, with the
#: white space behind them. Together they cover the paragraph.
BLOCK = r"[\x20\x09-\x0D]{1,64}|(?:[^\x20\x09-\x0D]{1,64}[\x20\x09-\x0D]{0,64}){1,4}"
#: Ranges of ids for each shuffle partition of the session.
RANGES_PER_PARTITION = 4


def node(children: Column) -> Column:
    """Hash of the whole hashes below."""
    return F.md5(F.array_join(children, ",").cast("binary"))


def fingerprint(text: Column) -> Column:
    """The Merkle tree of a text. Nodes cover whole hashes; those below the root are shown cut."""

    def paragraph(line: Column) -> Column:
        blocks = F.regexp_extract_all(line, F.lit(BLOCK), F.lit(0))
        leaves = F.array(F.transform(blocks, lambda b: F.md5(b.cast("binary"))))

        def tree(of: Column) -> Column:
            return F.struct(
                node(of).alias("hash"),
                F.array_join(F.transform(of, lambda x: F.substring(x, 1, 8)), ",").alias("below"),
            )

        return F.get(F.transform(leaves, tree), F.lit(0))

    def section(part: Column) -> Column:
        lines = F.filter(F.split(part, "\n"), lambda x: x != "")
        trees = F.array(F.transform(lines, paragraph))

        def tree(of: Column) -> Column:
            shown = F.transform(of, lambda p: F.concat(F.substring(p["hash"], 1, 16), F.lit(","), p["below"]))
            return F.struct(
                node(F.transform(of, lambda p: p["hash"])).alias("hash"), F.array_join(shown, ";").alias("below")
            )

        return F.get(F.transform(trees, tree), F.lit(0))

    # Line feeds count for the root: it covers the layout as well as the branches.
    layout = F.md5(F.regexp_replace(text, "[^\n]+", "x").cast("binary"))
    trees = F.array(F.transform(F.split(text, "\n\n"), section))

    def whole(of: Column) -> Column:
        heads = F.array_join(F.transform(of, lambda s: s["hash"]), ",")
        shown = F.transform(of, lambda s: F.concat(F.substring(s["hash"], 1, 16), F.lit("="), s["below"]))
        root_ = F.md5(F.concat_ws(",", layout, heads).cast("binary"))
        return F.concat(root_, F.lit(":"), F.array_join(shown, "|"))

    return F.get(F.transform(trees, whole), F.lit(0))


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def leaves(print_: Column) -> Column:
    """The distinct leaf hashes of a fingerprint."""
    return F.array_distinct(F.regexp_extract_all(print_, F.lit(r",([0-9a-f]{8})(?![0-9a-f])"), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    """Share of the leaves of two fingerprints that both have; 1 for equal roots."""
    x, y = leaves(a), leaves(b)
    both = F.size(F.array_intersect(x, y)).cast("double")
    share = F.try_divide(both, F.size(x) + F.size(y) - both)
    return F.when(root(a) == root(b), 1.0).otherwise(F.coalesce(share, F.lit(0.0)))


def differing(a: Column, b: Column) -> Column:
    """Paragraph hashes of ``b`` that ``a`` lacks: the branches where an edit lies."""

    def paragraphs(p: Column) -> Column:
        return F.regexp_extract_all(p, F.lit(r"[=;]([0-9a-f]{16}),"), F.lit(1))

    return F.array_except(paragraphs(b), paragraphs(a))


def in_ranges(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Add ``bin``: the place of a document's range of ids, in ascending order, null ids first.

    The ranges hold about as many documents each, and there are a few for each shuffle
    partition of the session; their list of boundaries is all that the driver sees.
    """
    if ranges is None:
        partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = RANGES_PER_PARTITION * partitions
    shares = [i / ranges for i in range(1, ranges)]
    edges = docs.agg(F.percentile_approx("doc_id", shares, 100 * ranges).alias("e")).first()["e"]
    edges = sorted(set(edges or []))
    if not edges:
        return docs.withColumn("bin", F.lit(0))
    bounds = F.from_json(F.lit(json.dumps(edges)), "array<long>")  # folded to a literal
    below = F.aggregate(
        F.sequence(F.lit(0), F.lit(len(edges).bit_length())),
        F.struct(F.lit(0).alias("a"), F.lit(len(edges)).alias("b")),
        lambda s, _: F.when(s["a"] >= s["b"], s).otherwise(
            F.when(
                F.get(bounds, F.floor((s["a"] + s["b"]) / 2).cast("int")) < F.col("doc_id"),
                F.struct(
                    (F.floor((s["a"] + s["b"]) / 2).cast("int") + 1).alias("a"), s["b"].alias("b")
                ),
            ).otherwise(
                F.struct(s["a"].alias("a"), F.floor((s["a"] + s["b"]) / 2).cast("int").alias("b"))
            )
        ),
    )
    return docs.withColumn("bin", F.when(F.col("doc_id").isNull(), -1).otherwise(below["a"]))


def with_next(docs: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """Add ``next_<value>`` of the following document by ascending id, cyclic.

    Ties in the id go by ``value``. The values of a range meet in one window; only the first
    of each range crosses to the range before.
    """
    name = f"next_{value}"
    rows = in_ranges(docs, ranges)
    order = [F.asc_nulls_first("doc_id"), F.asc_nulls_first(value)]
    key = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), F.col(value).alias("v"))
    firsts = rows.groupBy("bin").agg(F.min(key).alias("first"))
    turn = Window.orderBy("bin")  # one row for each range
    heads = firsts.select(
        "bin",
        F.coalesce(F.lead("first").over(turn), F.first("first").over(turn))["v"].alias("_head"),
    )
    inner = rows.withColumn(name, F.lead(value).over(Window.partitionBy("bin").orderBy(*order)))
    return (
        inner.join(heads, "bin")
        .withColumn(name, F.coalesce(name, "_head"))
        .drop("_head", "bin")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    # A document's tree is made once and goes with its text to the document before it.
    own = F.struct("text", fingerprint(F.col("text")).alias("fingerprint")).alias("own")
    made = with_next(docs.select("doc_id", own), "own").select("doc_id", "own.*", "next_own")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    following = F.col("next_own.text")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(following, F.lit(1), half))
    made = made.withColumns({"n_chars": n.cast("long"), "edited": edited})
    made = made.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_own.fingerprint")).alias("near_next"),
    )


def _sql_print(text: str) -> str:
    """The fingerprint of a text as a DuckDB expression."""

    def joined(items: str, by: str) -> str:
        return f"coalesce(array_to_string({items}, '{by}'), '')"

    def hashes(items: str) -> str:
        return f"list_transform({items}, lambda t: t.hash)"

    def shown(items: str, mark: str) -> str:
        return f"list_transform({items}, lambda t: concat(t.hash[1:16], '{mark}', t.below))"

    def tree(of: str, hash_: str, below: str) -> str:
        """A struct over the list ``of``, which is named once."""
        return f"list_transform([{of}], lambda x: {{'hash': md5({joined(hash_, ',')}), 'below': {below}}})[1]"

    leaves_ = f"list_transform(regexp_extract_all(l, '{BLOCK}'), lambda b: md5(b))"
    paragraph = tree(leaves_, "x", joined("list_transform(x, lambda h: h[1:8])", ","))
    lines = "list_filter(string_split(s, chr(10)), lambda l: l <> '')"
    section = tree(f"list_transform({lines}, lambda l: {paragraph})", hashes("x"), joined(shown("x", ","), ";"))
    sections = f"list_transform(string_split({text}, concat(chr(10), chr(10))), lambda s: {section})"
    layout = f"md5(regexp_replace({text}, '[^\\n]+', 'x', 'g'))"
    root_ = f"md5(concat({layout}, ',', {joined(hashes('x'), ',')}))"
    return f"list_transform([{sections}], lambda x: concat({root_}, ':', {joined(shown('x', '='), '|')}))[1]"


def _sql_likeness(a: str, b: str) -> str:
    x, y = (f"list_distinct(regexp_extract_all({p}, ',([0-9a-f]{{8}})', 1))" for p in (a, b))
    both = f"len(list_intersect({x}, {y}))"
    return f"""CASE WHEN split_part({a}, ':', 1) = split_part({b}, ':', 1) THEN 1.0::DOUBLE
        ELSE coalesce({both}::DOUBLE / nullif(len({x}) + len({y}) - {both}, 0), 0) END"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), (SELECT arg_min(text, doc_id) FROM d)) AS nxt FROM d),
e AS (SELECT *, concat(substr(text, 1, length(text) - length(text) // 2), substr(nxt, 1, length(text) // 2)) AS edited
      FROM n),
f AS (SELECT doc_id, text, edited, {_sql_print('text')} AS fingerprint,
             {_sql_print('edited')} AS edited_fingerprint, {_sql_print('nxt')} AS following FROM e)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       {_sql_likeness('fingerprint', 'edited_fingerprint')} AS near_edited,
       {_sql_likeness('fingerprint', 'following')} AS near_next
FROM f"""

QUERIES = {"op8_merkle_prints": query}
ORACLES = {"op8_merkle_prints": ORACLE}
