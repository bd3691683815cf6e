"""Lines, chats, benchmark passages, fingerprints and quality against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm import chat, decontaminate, line_spread, merkle, quality


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


# --- Line dedup ------------------------------------------------------------------------------


def docs_table(spark, rows):
    """(doc_id, text, source) with columns whose names clash with inner ones."""
    made = [(i, t, s, 1, "x", "y") for i, t, s in rows]
    schema = "doc_id long, text string, source string, pos int, h1 string, places string"
    return spark.createDataFrame(made, schema)


def plain_lines(rows, least):
    sites, first = defaultdict(set), {}
    for i, t, s in rows:
        for p, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                sites[line.strip(" ")].add(s)
    out = []
    # The place that stays is the smallest by id here: texts of one id are equal in the test.
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for p, line in enumerate((t or "").split("\n")):
            first.setdefault(line.strip(" "), (i, p))
    for i, t, _ in rows:
        kept = []
        for p, line in enumerate((t or "").split("\n")):
            key = line.strip(" ")
            wide = key and len(sites[key] - {None}) >= least and first[key] != (i, p)
            kept += [] if wide else [line]
        out.append((i, len((t or "").split("\n")) - len(kept), "\n".join(kept)))
    return out


def test_wide_lines_go(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        lines = [f"own {i} {j}" for j in range(rng.randint(0, 3))]
        lines += [f"wide {k}" for k in range(25) if rng.random() < (k + 1) / 25]
        lines += rng.choice([[], ["", " "], [" wide 24 ", "wide 24"]])
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice([None, *[f"s{k}" for k in range(14)]])))
    rows += [(5, rows[5][1], "s1"), (None, "wide 3\nwide 20", "s2"), (200, None, "s3"), (201, "", None)]
    made = line_spread.drop_wide_lines(docs_table(spark, rows), folder=str(tmp_path))
    got = Counter((r.doc_id, r.n_removed, r.text or "") for r in made.collect())
    want = plain_lines(rows, line_spread.MIN_SITES)
    assert got == Counter(want) and sum(n for _, n, _ in want) > 300
    assert set(made.columns) == {*docs_table(spark, rows).columns, "n_removed"}
    untouched = {r.doc_id: r.text for r in made.where("n_removed = 0").collect()}
    assert untouched[200] is None


# --- Chat ------------------------------------------------------------------------------------


def test_turns_are_read_back(spark):
    rng = random.Random(4)
    bits = [*chat.INSTRUCT.controls, "&#", "&#38;#", "&#60;", "&", "<", "[", "/s>", " ", "\n", "text", "é漢"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "to[INST]ol\nx", None]), text))
    rows += [(None, 1, "user", None), (50, 1, "user", "twice"), (50, 1, "user", "twice"), (51, None, "user", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.conversations(table.withColumn("parts", F.lit(1)))
    got = {r.conv_id: [tuple(t) for t in r.t] for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        want[conv].append((turn is not None, turn, role or "", text or ""))
    assert got == {c: [t[2:] for t in sorted(v)] for c, v in want.items()}
    assert chat.conversations(table.limit(0)).count() == 0


def test_order_of_turns(spark):
    orders = {1: "system user assistant", 2: "user assistant user assistant", 3: "assistant user", 4: "user",
              5: "user user assistant", 6: "system assistant", 7: "user system assistant"}
    rows = [(c, i, role, "x") for c, roles in orders.items() for i, role in enumerate(roles.split())]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ok = {r.conv_id for r in chat.conversations(table).where("order_ok").collect()}
    assert ok == {1, 2}


# --- Benchmark passages ------------------------------------------------------------------------


def plain_distance(pattern, text):
    """Least edits between a pattern and any stretch of a text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        nxt = [i]
        for j, b in enumerate(text, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (a != b)))
        row = nxt
    return min(row)


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "q" + text[at + 1 :]])
    return text


def test_every_window_within_the_budget_is_found(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choice(["ent", "thion", "er", "anders", "le", "oui", "s"]) for _ in range(n))
    items = [(i, prose(n)) for i, n in enumerate([3, 8, 15, 30, 60])] + [(9, None), (10, ""), (11, "zq")]
    docs = [(i, prose(40)) for i in range(20)]
    for i in range(40):
        item, text = rng.choice(items[:5])
        part = text if rng.random() < 0.5 else text[rng.randrange(len(text) // 3 + 1) :]
        docs.append((100 + i, f"{prose(10)}\n {edited(rng, part.upper(), rng.randint(0, 8))} {prose(10)}"))
    docs += [(100, docs[30][1]), (None, items[4][1]), (300, None), (301, "")]
    table = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for chars in (10**6, 150):
        found = decontaminate.contaminated(table, bench, chars).collect()
        want = Counter()
        for i, t in docs:
            own = decontaminate.plain(t or "")
            parts = defaultdict(set)
            for p in decontaminate.patterns([(k, x or "") for k, x in items]):
                text = "".join(map(chr, p.text))
                edits = 0 if text in own else plain_distance(text, own)
                if edits <= p.edits:
                    parts[p.item].add((p.number, edits))
            want.update((i, item, len(x), min(e for _, e in x)) for item, x in parts.items())
        assert Counter((r.doc_id, r.item_id, r.n_windows, r.edits) for r in found) == want
    assert len(want) > 20
    assert decontaminate.contaminated(table.limit(0), bench).count() == 0
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0


# --- Fingerprints ------------------------------------------------------------------------------


def test_edited_halves(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    docs = [(r.doc_id, r.text or "") for r in sorted(rows)]
    got = {r.doc_id: r for r in merkle.query(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        want = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
    same = defaultdict(set)
    for i, text in docs:
        same[text].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in same.values())
    assert len({x for v in same.values() for x in v}) == len(same)
    nearer = [r.near_edited > r.near_next for r in got.values()]
    assert np.mean(nearer) > 0.95


def test_fingerprints_and_branches(spark):
    texts = ["", "a", "a\n", "\na", "a\n\nb", "a\nb", "one two three four five\n\nsix", "one two three four five\n\nsiy"]
    prints = [value(spark, merkle.fingerprint(F.lit(t))) for t in texts]
    assert len(set(prints)) == len(texts)
    like = lambda a, b: value(spark, merkle.likeness(F.lit(prints[a]), F.lit(prints[b])))
    assert like(0, 0) == 1 and like(0, 1) == 0 and like(4, 5) == 1 and 0 < like(6, 7) < 1
    assert len(value(spark, merkle.differing(F.lit(prints[6]), F.lit(prints[7])))) == 1


def test_roots_cover_whole_hashes(spark):
    # The 32 shown bits of their leaves are equal.
    texts = ["w28254", "w130106"]
    assert len({hashlib.md5(t.encode()).hexdigest()[:8] for t in texts}) == 1
    prints = [value(spark, merkle.fingerprint(F.lit(t))) for t in texts]
    assert prints[0] != prints[1] and prints[0].split(":")[0] != prints[1].split(":")[0]
    assert value(spark, merkle.root(F.lit(prints[0]))) == prints[0].split(":")[0]


def test_fingerprint_of_a_long_text(spark):
    text = "\n\n".join(f"section {i} has\nsome words of its own {i * i}" for i in range(60_000))
    rows = spark.createDataFrame([(1, text), (2, text), (3, text[:-1] + "x")], "doc_id long, text string")
    got = [r.p for r in rows.select("doc_id", merkle.fingerprint(F.col("text")).alias("p")).orderBy("doc_id").collect()]
    assert got[0] == got[1] and got[0].split(":")[0] != got[2].split(":")[0]
    shared = set(got[0].split(":")[1].split("|")) & set(got[2].split(":")[1].split("|"))
    assert len(shared) == 59_999


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_next_document(spark, ranges):
    rows = [(i * i % 101, f"t{i}") for i in range(60)] + [(None, "none"), (None, None), (5, "tie")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "coalesce(text, '') text", "1 AS first")
    got = Counter((r.doc_id, r.text, r.next_text) for r in merkle.with_next(table, "text", ranges).collect())
    order = sorted(((i is not None, i or 0, t or ""), i, t or "") for i, t in rows)
    want = Counter((i, t, order[(k + 1) % len(order)][2]) for k, (_, i, t) in enumerate(order))
    assert got == want
    assert merkle.with_next(table.limit(0), "text").count() == 0
    assert [r.next_text for r in merkle.with_next(table.limit(1), "text").collect()] == [table.first().text]


# --- Quality -----------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    scores = {r.doc_id: r for r in quality.query(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held = [(scores[r.doc_id].predicted, r.quality) for r in labels if scores[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scores.values())
    assert len(scores) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_scores_of_odd_rows(spark):
    good = [(i, f"the quick text number {i} is plain", "x") for i in range(60)]
    bad = [(100 + i, f"BUY {i}!! NOW!! BUY!! NOW!!", "x") for i in range(60)]
    odd = [(None, None, "x"), (300, "", "x"), (301, " ", "x"), (301, " ", "x"), (302, "漢" * 5000, "x")]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string, score string")
    labels = [(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(60)] + [(300, None), (None, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    score = quality.fit(docs, labels)
    got = docs.select("doc_id", score(F.coalesce("text", F.lit(""))).alias("v")).collect()
    assert len(got) == docs.count() and all(0 <= r.v <= 1 for r in got)
    by_id = {r.doc_id: r.v for r in got}
    assert min(by_id[i] for i in range(60)) > max(by_id[100 + i] for i in range(60))
    assert quality.fit(docs.limit(0), labels.limit(0))


def plain_shape(word):
    """Letter classes of a word by the character database, runs as one letter."""
    kinds = []
    for c in word:
        kind = unicodedata.category(c)
        kinds.append("A" if kind in ("Lu", "Lt") else "a" if kind[0] in "LM" else "0" if kind[0] == "N" else c)
    return "".join(k for k, _ in itertools.groupby(kinds))


def test_shapes_are_whole_and_by_code_point():
    words = "Word!! word É Ж ١٢ ab1ab1ab1ab1 ab1ab1ab1ab2 ab1ab1ab1ab! ß漢字 Ǆa É́b ... ..! a.b.c.d.e.f.g A".split()
    _, forms, sizes = quality.rows_of(pa.array(words, pa.large_string()), 64)
    by_shape = {}
    for word, form in zip(words, forms.tolist()):
        by_shape.setdefault(plain_shape(word), set()).add(form)
    assert all(len(x) == 1 for x in by_shape.values())
    assert len(set.union(*by_shape.values())) == len(by_shape) < len(words)
    assert sizes.tolist() == [len(w) for w in words]
    sliced = quality.rows_of(pa.array(words, pa.large_string()).slice(3, 5), 64)
    assert sliced[1].tolist() == forms[3:8].tolist()


def plain_vectors(texts, rows):
    """Sums of the index vectors of neighbours, token by token."""
    size = rows + quality.SHAPE_ROWS
    places, signs = quality.index_vectors(size)
    out = np.zeros((size, quality.DIMS))
    for text in texts:
        words = (text or "").split()
        found = [quality.rows_of(pa.array([w], pa.large_string()), rows) for w in words]
        for stream in (0, 1):
            ids = [int(f[stream][0]) for f in found]
            for i, own in enumerate(ids):
                for j in range(max(0, i - quality.WINDOW), min(len(ids), i + quality.WINDOW + 1)):
                    if i != j:
                        near = size if ids[j] == own else ids[j]
                        np.add.at(out[own], places[near], signs[near])
    return out


def test_vectors_and_features_by_hand(spark):
    rng = random.Random(12)
    vocabulary = ["the", "The", "é9", "漢字", "a!", "buy", "BUY!!", "x" * 40, "it's"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(40)]
    texts += ["", None, "one", " \t ", "same same same"]
    rows = 32
    want = plain_vectors(texts, rows)
    got = sum(quality.cooccurrence(pa.array([t or ""]), rows) for t in texts)
    assert np.array_equal(got.reshape(want.shape), want)
    assert np.array_equal(quality.cooccurrence(pa.array([t or "" for t in texts]), rows).reshape(want.shape), want)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, block int")
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1)
    for part in (want[:rows], want[rows:]):
        used = np.abs(part).sum(axis=1) > 0
        part[used] -= part[used].mean(axis=0)
    table = quality.word_vectors(docs.repartition(3), rows)
    assert np.allclose(table, want, atol=1e-6)
    made = quality.features(pa.array([t or "" for t in texts]), table)
    d = quality.DIMS
    for text, x in zip(texts, made):
        words = (text or "").split()
        if not words:
            assert not x.any()
            continue
        word, form, size = quality.rows_of(pa.array(words, pa.large_string()), rows)
        assert np.allclose(x[:d], table[word].mean(axis=0), atol=1e-5)
        assert np.allclose(x[d : 2 * d], table[form].mean(axis=0), atol=1e-5)
        again = sum(a == b for a, b in zip(words, words[1:]))
        plain = [np.log1p(len(words)), len(set(words)) / len(words), again / len(words), np.mean(size)]
        assert np.allclose(x[2 * d :], plain, atol=1e-5)
    with pytest.raises(ValueError):
        quality.word_vectors(docs, 33)


def test_temperature_is_the_best_of_its_grid():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6))
    y = (x[:, 0] + rng.normal(size=400) > 0).astype(float)
    net = quality.train(x, y)
    kept = np.arange(len(x)) % 5 == 4
    raw, truth = net.logits(x[kept]), y[kept]

    def loss(t):
        p = 1 / (1 + np.exp(-raw / t))
        return -np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p))

    grid = np.exp(np.linspace(-1.5, 2.5, 81))
    assert loss(net.temperature) <= min(loss(t) for t in grid) + 1e-9
    assert np.allclose(net.score(x), 1 / (1 + np.exp(-net.logits(x) / net.temperature)))


def test_scores_of_empty_and_very_long_texts(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    score = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), rows=1024)
    assert docs.limit(0).select(score("text")).count() == 0
    body = " ".join(r.text or "" for r in docs.select("text").limit(60).collect())
    long = body * (1 + 5_000_000 // len(body))
    rows = spark.createDataFrame([(1, long), (2, long), (3, "x" * 3_000_000), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.v for r in rows.select("doc_id", score("text").alias("v")).collect()}
    assert got[1] == got[2] and all(0 <= v <= 1 for v in got.values()) and len(got) == 4


def test_passages_off_the_grid_are_found(spark):
    rng = random.Random(31)
    item = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(70))
    length = decontaminate.WINDOW + 9
    quotes = [(at, f"Before it {item[at : at + length]} after it") for at in range(0, len(item) - length + 1, 3)]
    docs = spark.createDataFrame(quotes, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {at for at, _ in quotes}
