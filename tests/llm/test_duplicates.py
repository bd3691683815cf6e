"""Near-duplicates and repeated substrings against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from lotwise.llm import bwt_merge, doubling, graph, simhash_bk


def table(spark, rows):
    """Rows (doc_id, text) with columns whose names clash with those the operators use."""
    made = [(i, t, "x", 1, b"z", 2) for i, t in rows]
    schema = "doc_id long, text string, th string, place int, z binary, fp int"
    return spark.createDataFrame(made, schema)


def words(rng, n, kinds=200):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Random texts with copies, shared passages, loops, edits, nulls and repeated rows."""
    rng = random.Random(8)
    shared = [words(rng, 60) for _ in range(4)]
    rows = [(i, words(rng, rng.choice([0, 3, 40, 120]))) for i in range(60)]
    rows += [(100 + i, f"{words(rng, 20)} {shared[i % 4]} {words(rng, 20)}") for i in range(24)]
    rows += [(200 + i, rows[70][1]) for i in range(5)] + [(300, "same " * 150), (301, "ab " * 90)]
    edited = rows[70][1].split()
    for i in range(6):
        own = edited[:]
        own[7 * i + 3] = "edit"
        rows.append((400 + i, " ".join(own)))
    rows += [(7, rows[7][1]), (8, "other text of the same id"), (None, shared[0]), (None, None), (500, None), (501, " \n\t")]
    return rows


# --- SimHash -------------------------------------------------------------------------------


def plain_print(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes, linked):
    top = {x: x for x in nodes}
    for _ in nodes:
        changed = False
        for a, b in linked:
            low = min(top[a], top[b])
            changed |= top[a] != low or top[b] != low
            top[a] = top[b] = low
        if not changed:
            break
    return top


def test_fingerprints():
    for text in ["", None, "One", "Two words", "AÉ b\x0bc\x0cd", "a a a a a a", "x y z"]:
        assert simhash_bk.fingerprint((text or "").encode()) == plain_print(text)


def test_bk_tree():
    rng = random.Random(1)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash_bk.BKTree(values)
    for asked in range(0, 4096, 97):
        near = sorted({v for v in values if (v ^ asked).bit_count() <= 2})
        assert sorted(tree.within(asked, 2)) == near
        best = sorted({((v ^ asked).bit_count(), v) for v in values if v != asked})[:3]
        assert tree.nearest(asked, 5, 3) == [v for d, v in best if d <= 5]
    assert simhash_bk.BKTree([]).within(1, 2) == []


@pytest.mark.parametrize("tree_size", [3, 4096])
def test_near_pairs(spark, tree_size):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    flips = [np.uint64(0), np.uint64(1) << np.uint64(63), np.uint64(0b11), np.uint64(0b10101)]
    values = sorted({int(b ^ f) for b in base for f in flips})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {frozenset((r.a, r.b)) for r in simhash_bk.near_pairs(fps, tree_size=tree_size).collect()}
    near = {
        frozenset((signed[i], signed[j]))
        for i, j in itertools.combinations(range(len(values)), 2)
        if (values[i] ^ values[j]).bit_count() <= 2
    }
    assert got == near and len(near) > 50
    with pytest.raises(ValueError):
        simhash_bk.near_pairs(fps, radius=3)


def test_near_groups(spark, corpus, tmp_path):
    got = simhash_bk.near_groups(table(spark, corpus), str(tmp_path)).collect()
    prints = {(i, t): plain_print(t) for i, t in corpus}
    kinds = sorted(set(prints.values()))
    linked = [(a, b) for a, b in itertools.combinations(kinds, 2) if (a ^ b).bit_count() <= 2]
    top = smallest_reachable(kinds, linked)
    least = defaultdict(list)
    for (i, _), p in prints.items():
        if i is not None:
            least[top[p]].append(i)
    want = Counter((i, prints[i, t], min(least[top[prints[i, t]]], default=None)) for i, t in corpus)
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want


def test_components(spark, tmp_path):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(300, 300)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    rng.shuffle(edges)
    links = spark.createDataFrame([*edges, (None, 1)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links, str(tmp_path)).collect()}
    assert got == smallest_reachable(sorted({x for e in edges for x in e}), edges)
    assert graph.components(links.limit(0), str(tmp_path)).count() == 0


def test_similar_groups_keep_one_each(spark, corpus, tmp_path):
    rng = random.Random(9)
    base = words(rng, 150, 5000).split()
    rows = [(i, words(rng, 150, 5000)) for i in range(1000, 1020)]
    for i in range(30):
        own = base[:]
        own[5 * i % 150] = f"new{i}"
        rows.append((2000 + i, " ".join(own)))
    rows += [(3000, " ".join(base).upper()), (3000, " ".join(base).upper()), (None, rows[0][1]), (4000, None)]
    kept = simhash_bk.similar_groups(table(spark, rows), str(tmp_path)).where("kept").collect()
    assert sorted(r.key for r in kept) == [*range(1000, 1020), 2000, 4000]


def kept_ids(spark, rows, folder):
    kept = simhash_bk.similar_groups(table(spark, rows), str(folder)).where("kept").collect()
    return sorted(r.key for r in kept)


def plain_kept(rows):
    """Smallest id of each group of texts with distinct shingles alike, all pairs compared."""
    sets = [set(simhash_bk.shingle_hashes(t.encode(), 5).tolist()) for _, t in rows]
    pairs = itertools.combinations(range(len(rows)), 2)
    linked = [(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    top = smallest_reachable(range(len(rows)), linked)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[top[i]].append(key)
    return sorted(map(min, least.values()))


def test_similar_groups_link_tight_families(spark, tmp_path):
    """A text has more near copies in its family than places for the nearest."""
    rows = []
    for trial in range(6):
        rng = random.Random(trial)
        base = words(rng, 300, 5000).split()
        for family in range(2):
            middle = base[:]
            for place in (50, 150, 250):
                middle[place] = f"f{trial}x{family}x{place}"
            for i in range(40):
                own = middle[:]
                own[(7 * i) % 300] = f"o{trial}x{family}x{i}"
                rows.append((trial * 1000 + family * 100 + i, " ".join(own)))
    # Pages of one template with a partner each for a few of them.
    rng = random.Random(77)
    frame = words(rng, 150, 5000)
    pages = [(10_000 + i, f"{frame} {words(rng, 30, 10**6)}") for i in range(60)]
    rows += pages + [(20_000 + i, f"{pages[9 * i][1]} {words(rng, 12, 10**6)}") for i in range(6)]
    assert kept_ids(spark, rows, tmp_path) == plain_kept(rows)


def test_similar_groups_ignore_repeats_of_a_line(spark, tmp_path):
    """A repeated line hardly changes the set of shingles, however often it stands there."""
    rows = []
    for i in range(24):
        rng = random.Random(500 + i)
        body, line = words(rng, 200, 5000), words(rng, 10, 5000)
        rows += [(i, body), (100 + i, f"{body} {' '.join([line] * (10, 20, 60)[i % 3])}")]
    assert kept_ids(spark, rows, tmp_path) == plain_kept(rows) == list(range(24))
    texts_ = simhash_bk.pressed(simhash_bk.with_text_hash(table(spark, rows)))
    signs = simhash_bk.signatures(texts_, 0.8, str(tmp_path))
    prints = {r.th: r.fp for r in signs.collect()}
    ths = [r.th for r in simhash_bk.with_text_hash(table(spark, rows)).collect()]
    for a, b in zip(ths[::2], ths[1::2]):
        assert ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= simhash_bk.SIMILAR_RADIUS


def test_similar_groups_link_texts_of_one_fingerprint(spark, tmp_path):
    """One line outweighs all bodies in a majority with repeats; the first text is like no other."""
    rng = random.Random(12)
    line, core = words(rng, 9, 10**6), words(rng, 150, 10**6)
    rows = []
    for i in range(40):
        own = words(rng, 30, 10**6).split()
        loop = " ".join([line] * 300)
        rows.append((i, f"{core} {' '.join(own)} {loop}"))
        own[3] = "other"
        rows.append((100 + i, f"{core} {' '.join(own)} {loop}"))
    assert kept_ids(spark, rows, tmp_path) == plain_kept(rows) == list(range(40))


def test_similar_groups_link_texts_without_a_common_bucket(spark, tmp_path):
    long = " ".join(f"r116218x{i}" for i in range(9))
    rows = [(1, long), (2, long.rsplit(" ", 1)[0]), (3, "unlike any of the texts before")]
    keys = [set(simhash_bk.band_keys(simhash_bk.shingle_hashes(t.encode(), 5))) for _, t in rows]
    assert not keys[0] & keys[1]
    assert kept_ids(spark, rows, tmp_path) == plain_kept(rows) == [1, 3]


# --- Repeated windows ------------------------------------------------------------------------


def plain_words(rows, n):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[s : s + n]) for w in texts for s in range(len(w) - n + 1))
    for (i, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            if seen[tuple(w[s : s + n])] > 1:
                gone[s : s + n] = [True] * n
        yield i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)


@pytest.mark.parametrize("n", [1, 7, 35])
def test_repeated_words_go(spark, corpus, tmp_path, n):
    got = doubling.drop_repeats(table(spark, corpus), n, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(plain_words(corpus, n))


def plain_bytes(rows, n):
    """Rows that share id and text are one document; null ids come first."""
    order = lambda r: (r[0] is not None, r[0] or 0, simhash_th(r[1]))
    first: dict[bytes, tuple] = {}
    out = {}
    for i, t in sorted(set(rows), key=order):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - n + 1):
            if first.setdefault(raw[s : s + n], (i, t, s)) != (i, t, s):
                gone[s : s + n] = b"\1" * n
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i, t] = (i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return [out[row] for row in rows]


def simhash_th(text):
    value = xxhash.xxh3_64_intdigest((text or "").encode())
    return value - (1 << 64) if value >= 1 << 63 else value


@pytest.mark.parametrize(("n", "spans"), [(12, 4096), (100, 4096), (40, 2)])
def test_repeated_bytes_go(spark, corpus, tmp_path, monkeypatch, n, spans):
    monkeypatch.setattr(bwt_merge, "BUCKET_SPANS", spans)
    got = bwt_merge.drop_repeats(table(spark, corpus), n, str(tmp_path)).collect()
    digests = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert Counter(digests) == Counter(plain_bytes(corpus, n))


@pytest.mark.parametrize("spans", [4096, 2])
def test_repeated_rows_keep_their_bytes(spark, tmp_path, monkeypatch, spans):
    monkeypatch.setattr(bwt_merge, "BUCKET_SPANS", spans)
    rng = random.Random(21)
    shared = words(rng, 40, 5000)
    long = f"{words(rng, 60, 5000)} {shared} {words(rng, 60, 5000)}"
    rows = [(7, long), (7, long), (None, f"{shared} {words(rng, 20, 5000)}"), (9, f"{words(rng, 30, 5000)} {shared}")]
    got = bwt_merge.drop_repeats(table(spark, rows), 40, str(tmp_path)).collect()
    digests = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert Counter(digests) == Counter(plain_bytes(rows, 40))


def test_suffixes_of_a_collection_are_in_order():
    rng = random.Random(6)
    for _ in range(40):
        members = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 9))]
        members += [b"a" * 70, b"", b"a" * 70]
        text = np.concatenate([np.append(np.frombuffer(x, np.uint8) + 1, np.uint8(0)) for x in members])
        ends = np.flatnonzero(text == 0)
        # Each terminator as a pair, the earlier the smaller.
        spelt = [(int(c), 0) if c else (0, i) for i, c in enumerate(text)]
        plain = sorted(range(len(text)), key=lambda i: spelt[i : int(ends[np.searchsorted(ends, i)]) + 1])
        assert bwt_merge.suffix_order(text, ends).tolist() == plain


@pytest.mark.parametrize("longest, at_once", [(8, 1), (8, 8), (40, 4), (40, 8)])
def test_merged_transforms_give_the_repeats(monkeypatch, longest, at_once):
    monkeypatch.setattr(bwt_merge, "AT_ONCE", at_once)
    rng = random.Random(5)
    for _ in range(60):
        size = rng.randint(1, 12)
        members = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(size)]
        members += [x + members[0] * rng.randint(0, 3) + x for x in members[:3]]
        n = rng.randint(1, longest)
        places = defaultdict(set)
        for k, raw in enumerate(members):
            for s in range(len(raw) - n + 1):
                places[raw[s : s + n]].add((k, s))
        found = defaultdict(set)
        for interval, member, offset in zip(*bwt_merge.repeated_starts(members, n)):
            found[interval].add((int(member), int(offset)))
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in places.values() if len(v) > 1)


def test_empty_tables(spark, tmp_path):
    empty = table(spark, [(1, "x")]).limit(0)
    folder = str(tmp_path)
    assert doubling.drop_repeats(empty, folder=folder).count() == 0
    assert bwt_merge.drop_repeats(empty, folder=folder).count() == 0
    assert simhash_bk.near_groups(empty, folder).count() == 0
    assert simhash_bk.similar_groups(empty, folder).count() == 0
