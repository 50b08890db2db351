"""Defined cases of every operator: nulls, empty and long texts, ties,
repeated rows, empty tables, further columns; against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marquee.llm import (bpe, divergence, exact_dedup, fingerprints, jaccard_join, licenses, mixing, near_dedup, packed_terms,
                         packing, phrases, sharding, substrings, toxicity)
from tests.llm.fixtures import clashing, frame, passage, rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

MODEL = toxicity.Model({w + "$": 2.0 for w in toxicity.INSULTS}, toxicity.DEFAULT_WEIGHTS)
OPERATORS = {
    "near": near_dedup.near_groups, "mix": mixing.copies, "licenses": licenses.scan,
    "substrings": substrings.removal_digests, "bpe": bpe.token_digests, "shards": sharding.curve_shards,
    "packing": packing.pack, "fingerprints": fingerprints.edited_fingerprints, "exact": exact_dedup.exact_groups,
    "toxicity": lambda d: toxicity.scores(d, MODEL), "join": jaccard_join.joined,
}


def collected(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"packing"}))
def test_one_row_a_document_and_clashing_columns(spark, name):
    df = frame(spark)
    plain, more = OPERATORS[name](df), OPERATORS[name](clashing(df))
    assert plain.columns == more.columns
    want = Counter(str(r) for r in plain.collect())
    assert sum(want.values()) == len(rows())
    assert want == Counter(str(r) for r in more.collect())


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact(spark, keep):
    groups = defaultdict(list)
    for r in rows():
        groups[(r[1] or "").translate(LOW)].append(r[0])
    want, kept = Counter(), 0
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "min" else max)(known) if known else None
        for i in ids:
            want[i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()] += 1
    got = exact_dedup.exact_groups(frame(spark), keep=keep).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    left = exact_dedup.exact_dedup(clashing(frame(spark)), keep=keep)
    assert left.columns == clashing(frame(spark)).columns
    assert sorted((r.text or "").translate(LOW) for r in left.collect()) == sorted(groups)
    assert sum(r.kept for r in got) == len(groups)


def test_exact_hot_group_spans_partitions(spark):
    data = [(i, "same text" if i % 3 else f"text {i}", "en", "a", 1) for i in range(3000)]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, data).repartition(16), keep="max").collect()}
    assert all(got[i].keep_id == 2999 and got[i].group_size == 2000 for i in range(3000) if i % 3)
    assert sum(r.kept for r in got.values()) == 1001


def similar(a, b, k, percent):
    def shingles(t):
        w = WORD.findall((t or "").translate(LOW))
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    x, y = shingles(a), shingles(b)
    return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)


def test_near(spark):
    data = [r for r in rows() if r[0] is not None]
    text = {r[0]: r[1] for r in data}
    comp = {i: i for i in text}
    for _ in text:
        for i in text:
            for j in text:
                if similar(text[i], text[j], 3, 85):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    got = near_dedup.near_groups(frame(spark, data)).collect()
    assert {r.doc_id: r.component_id for r in got} == comp
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert comp[8] == 7 and comp[3] == 1
    stay = near_dedup.near_dedup(frame(spark))
    assert stay.columns == frame(spark).columns
    assert {r.doc_id for r in stay.collect()} >= {1, 7, None}


def test_near_chain_and_crowd(spark):
    """A long chain of links is one component; a crowd of near copies too."""
    base = [f"c{i}" for i in range(400)]
    chain = [(i, " ".join(base[i * 8:i * 8 + 200]), "en", "a", 1) for i in range(25)]
    crowd = []
    for i in range(120):
        w = [f"k{j}" for j in range(300)]
        w[(i * 13) % 290] = f"x{i}"
        crowd.append((1000 + i, " ".join(w), "en", "a", 1))
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, chain + crowd)).collect()}
    assert {got[i] for i in range(25)} == {0}
    assert {got[1000 + i] for i in range(120)} == {1000}


def forest_rows(tree, labels, n=300, bits=None):
    import pyarrow as pa

    b1, b2 = bits or ([0] * len(labels), [0] * len(labels))
    return pa.RecordBatch.from_pydict({
        "tree": [tree] * len(labels), "label": [b"".join(v.to_bytes(4) for v in x) for x in labels],
        "cls": list(range(len(labels))), "n": [n] * len(labels), "b1": b1, "b2": b2})


def test_near_crowded_regions_of_all_trees():
    trees = [near_dedup.tree_choice(t) for t in range(near_dedup.TREES)]
    first = [j for t in trees for j in t[:near_dedup.BASE]]
    assert sorted(first) == list(range(near_dedup.HASHES))
    assert all(len(set(t)) == near_dedup.DEPTH for t in trees)
    for tree in range(near_dedup.TREES):
        batch = forest_rows(tree, [(1, 2, 3, 4, i, i, i, i) for i in range(9)])
        got = [r for b in near_dedup._regions([batch], 80) for r in b.to_pylist()]
        assert sorted(r["y"] for r in got if r["kind"] == 1) == list(range(9))


def test_near_short_sets_need_no_sketch(spark):
    label = (1, 2, 3, 4, 5, 6, 7, 8)
    far = ([0, (1 << 48) - 1], [0, (1 << 48) - 1])
    short = near_dedup._regions([forest_rows(0, [label, label], 5, far)], 80)
    assert [r for b in short for r in b.to_pylist() if r["kind"] == 0] == [{"kind": 0, "x": 0, "y": 1}]
    large = near_dedup._regions([forest_rows(0, [label, label], 5000, far)], 80)
    assert not [r for b in large for r in b.to_pylist() if r["kind"] == 0]
    # nine words against their first eight: 4 of 5 shingles of five words, exactly 0.8
    data = []
    for i in range(1000):
        w = [f"w{i}x{j}" for j in range(9)]
        data += [(2 * i, " ".join(w), "en", "a", 1), (2 * i + 1, " ".join(w[:8]), "en", "a", 1)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, data), 5, 80).collect()}
    assert all(got[2 * i + 1] == 2 * i for i in range(1000))


def small_group_pairs(labels):
    """Plain definition: neighbours of a region, and the pairs of groups of at most SMALL."""
    want = set()
    for i, p in enumerate(labels):
        for j in range(i + 1, len(labels)):
            d = next((k for k in range(8) if p[k] != labels[j][k]), 8)
            if d >= near_dedup.BASE and (j == i + 1 or sum(x[:d] == p[:d] for x in labels) <= near_dedup.SMALL):
                want.add((i, j))
    return want


def test_near_regions_are_streamed():
    import random

    rng = random.Random(3)
    labels = sorted(tuple(rng.randint(0, 1) if k in (2, 4, 5, 6) else rng.randint(0, 3) if k == 7 else 0 for k in range(8))
                    for _ in range(40)) + sorted((9, 9, 9, i // 2, i, 0, 0, 0) for i in range(9))
    batch = forest_rows(3, labels)
    got = [r for b in near_dedup._regions((batch.slice(i, 7) for i in range(0, 49, 7)), 80) for r in b.to_pylist()]
    assert {(r["x"], r["y"]) for r in got if r["kind"] == 0} == small_group_pairs(labels)
    sizes = Counter(x[:4] for x in labels)
    crowded = {i for i, x in enumerate(labels) if sizes[x[:4]] > near_dedup.SMALL or x[:4] in (labels[0][:4], labels[-1][:4])}
    assert {r["y"] for r in got if r["kind"] == 1} == crowded
    # a region of any size is handed on while it is read
    read = []

    def crowd():
        for i in range(40):
            read.append(i)
            yield forest_rows(0, [(1, 2, 3, 4, i, j, 0, 0) for j in range(1000)])
    next(near_dedup._regions(crowd(), 80))
    assert len(read) < 20


def test_near_main_classes_are_sent_once(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ITEMS", 100)
    met = [(5, v, 0 if v < 60 else v, 20) for v in range(64)]
    schema = "region long, vertex long, component long, n long"
    got = near_dedup.meetings(spark.createDataFrame(met, schema)).collect()
    sent = Counter(r.vertex for r in got)
    assert all(sent[v] == 1 for v in range(60)) and all(sent[v] == 12 for v in range(60, 64))
    # several blocks of others: every pair with a class outside the main component meets
    met = [(5, v, 0 if v < 30 else v, 20) for v in range(60)]
    at = defaultdict(set)
    for r in near_dedup.meetings(spark.createDataFrame(met, schema)).collect():
        at[r.lo, r.hi].add(r.vertex)
    pairs = {(a, b) for vs in at.values() for a in vs for b in vs if a < b}
    assert {(a, b) for b in range(30, 60) for a in range(b)} <= pairs


def test_components(spark):
    n = 300
    links = [(i, i + 1) for i in range(n) if i % 50 != 49] + [(7, 260)]
    got = {r.vertex: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: i // 50 * 50 for i in range(n + 1)}
    for i in range(250, 300):
        want[i] = 0
    assert {k: want[k] for k in got} == got


def test_substrings(spark):
    data = [r for r in rows()]
    seen = {}
    for r in data:
        w = WORD.findall(r[1] or "")
        for i in range(len(w) - 49):
            if r[0] is not None:
                k = tuple(w[i:i + 50])
                seen[k] = min(seen.get(k, r[0]), r[0])
    want = Counter()
    for r in data:
        w = WORD.findall(r[1] or "")
        gone = set()
        for i in range(len(w) - 49):
            if r[0] is not None and seen[tuple(w[i:i + 50])] < r[0]:
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert collected(substrings.removal_digests(frame(spark)), *cols) == want
    assert collected(substrings.removal_digests(frame(spark), hot=1), *cols) == want   # all buckets hot
    texts = {r.doc_id: r.text for r in substrings.deduplicated(frame(spark)).collect()}
    assert texts[3] == "" and len(texts[14].split()) == 70


def test_bpe(spark):
    c = bpe.codec(bpe.default_vocabulary())
    want = Counter()
    for r in rows():
        ids = c.bpe.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (500, 40)):
        got = bpe.token_digests(frame(spark), chunk=chunk, overlap=overlap)
        assert collected(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    back = bpe.decode(bpe.encode(frame(spark))).collect()
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back) == Counter((r[0], (r[1] or "").encode()) for r in rows())


def test_packing(spark):
    import numpy as np

    c = bpe.codec(bpe.default_vocabulary())
    want = Counter()
    for r in rows():
        want[r[0], tuple(c.bpe.encode_ordinary(r[1] or ""))] += 1
    del want[4, ()], want[5, ()]
    pieces = defaultdict(list)
    for r in packing.pack(frame(spark).coalesce(1), length=256).collect():
        ids = np.frombuffer(bytes(r.ids), dtype="<u2")
        assert len(ids) == 256 and (ids[r.n_tokens:] == len(c.length)).all()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 256
        assert r.position_resets == r.cu_seqlens[:-1]
        for d, s, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            pieces[d].append((s, tuple(ids[a:b])))
    tokens = Counter()
    for d, got in pieces.items():
        tokens[d] = sum(len(p) for _, p in got)
    assert tokens == Counter({d: n for d, n in _lengths(want).items() if n})
    for d in (7, 9, 12, 16, 17):
        if sum(k[0] == d for k in want) == 1 and want[next(k for k in want if k[0] == d)] == 1:
            assert sum((p for _, p in sorted(pieces[d])), ()) == next(k[1] for k in want if k[0] == d)


def test_packing_under_a_large_vocabulary(spark, tmp_path):
    import base64

    import numpy as np

    # the bytes, then 70,000 made-up tokens: ids of over 16 bits
    tokens = [bytes([i]) for i in range(256)] + [b"zq%d" % i for i in range(70_000)]
    path = tmp_path / "large.tiktoken"
    path.write_bytes(b"\n".join(b"%s %d" % (base64.b64encode(t), i) for i, t in enumerate(tokens)))
    df = frame(spark, [(1, "zq69999", "en", "a", 1)])
    assert packing.padding(str(path)) == (70_256, "<u4")
    want = bpe.codec(str(path)).encode("zq69999").tolist()
    r = packing.pack(df, length=16, path=str(path)).first()
    ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
    assert ids == want + [70_256] * (16 - len(want)) and packing.padding()[1] == "<u2"


def _lengths(want):
    out = Counter()
    for (d, ids), n in want.items():
        out[d] += n * len(ids)
    return out


def test_best_fit_is_best_fit():
    import random

    rng = random.Random(5)
    lengths = [rng.randint(1, 64) for _ in range(500)]
    rooms, want = [], []
    for p in sorted(range(500), key=lambda p: (-lengths[p], p)):
        fit = [x for x in rooms if x >= lengths[p]]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - lengths[p])
        else:
            rooms.append(64 - lengths[p])
            want.append(0)
    got = packing.best_fit(lengths, 64)
    assert len(got) == len(rooms)
    assert sorted(64 - sum(lengths[p] for p in r) for r in got) == sorted(rooms)
    assert sorted(p for r in got for p in r) == list(range(500))


def test_mixing(spark):
    got = mixing.copies(frame(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    sizes = defaultdict(int)
    for r in rows():
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    left, free = float(sum(sizes.values())), set(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    target |= share
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 3
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.copies(frame(spark).repartition(7)).collect()))
    out = Counter(r.doc_id for r in mixing.mix(clashing(frame(spark))).collect())
    copies = Counter()
    for r in got:
        copies[r.doc_id] += r.copies
    assert out == +copies


def test_mixing_meets_targets(spark):
    data = [(i, " ".join("w" * 3 for _ in range(5 + i * 37 % 90)), "en", f"s{i % 4}" if i % 2 else "hot", 1)
            for i in range(4000)]
    got = mixing.copies(frame(spark, data)).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    for s, t in target.items():
        assert taken[s] == pytest.approx(t, rel=0.01)


def hilbert_order(bits, n):
    """All grid points along the curve, built by rotating half-size curves
    (the plain recursive definition for two dimensions)."""
    if bits == 0:
        return [(0, 0)]
    half, m = hilbert_order(bits - 1, n), 1 << (bits - 1)
    return ([(y, x) for x, y in half] + [(x, y + m) for x, y in half] + [(x + m, y + m) for x, y in half]
            + [(2 * m - 1 - y, m - 1 - x) for x, y in half])


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve(spark, dims, bits):
    """Every cell once; neighbours on the curve differ by one in one axis."""
    from itertools import product

    from pyspark.sql import functions as F

    cells = list(product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, [f"c{i}" for i in range(dims)])
    got = df.select("*", sharding.hilbert_index([F.col(f"c{i}") for i in range(dims)], bits).alias("k")).collect()
    line = [tuple(r)[:dims] for r in sorted(got, key=lambda r: r.k)]
    assert sorted(r.k for r in got) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(line, line[1:]))
    if dims == 2:
        plain = hilbert_order(bits, 2)
        assert line in (plain, [(y, x) for x, y in plain])


def test_shards(spark):
    got = sharding.curve_shards(frame(spark), shards=5).collect()
    n = len(rows())
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) <= set(range(5)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for s, rs in by.items():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    import zlib
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows())
    line = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in line] == sorted(r.curve for r in got) and len(line) == n


def test_shards_tell_sources_with_a_common_beginning(spark):
    data = [(i, "same size", "language_" + "ab"[i // 8 % 2], f"https://site.example/{i % 8}", 1) for i in range(320)]
    source = {r[0]: (r[3], r[2]) for r in data}
    got = sharding.curve_shards(frame(spark, data), shards=16).collect()
    cells = defaultdict(set)
    for r in got:
        cells[r.curve].add(source[r.doc_id])
    assert len(cells) == 16 and all(len(c) == 1 for c in cells.values())


def test_text_cuts_are_quantiles(spark):
    import random

    rng = random.Random(2)
    values = [f"common beginning {int(rng.expovariate(0.02)):04d}" if rng.random() < 0.7 else "hot" for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    line = sorted(values)
    assert sharding.text_cuts(df, "v", 4).first()[0] == [line[-(-i * 3000 // 16) - 1] for i in range(1, 16)]


def vector(text):
    """Paragraphs, and the sums of their entries as plain numbers (no modulus)."""
    import xxhash
    from collections import Counter

    parts = [p for p in re.split(fingerprints.PARAGRAPH_END, text) if p]
    v = [0] * 60
    for p, times in Counter(parts).items():
        h = xxhash.xxh64_intdigest(p.encode(), seed=42)
        h = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed=42)
        for i in range(30):
            w = xxhash.xxh64_intdigest((i + 1).to_bytes(4, "little"), seed=h)
            for lane in range(2):
                v[2 * i + lane] += times * (w >> 31 * lane & 3)
    return len(parts), v


def hexed(text):
    n, v = vector(text)
    return f"{n:016x}" + "".join(f"{v[2 * i] % (1 << 31) | v[2 * i + 1] % (1 << 31) << 31:016x}" for i in range(30))


def cosine(a, b):
    def centred(t):
        n, v = vector(t)
        return [2 * c - 3 * n for c in v]
    x, y = centred(a), centred(b)
    xx, yy = sum(c * c for c in x), sum(c * c for c in y)
    if not xx or not yy:
        return 1.0 if xx == yy else 0.0
    return min(1.0, max(0.0, sum(p * q for p, q in zip(x, y)) / (xx * yy) ** 0.5))


def test_fingerprints(spark):
    from pyspark.sql import functions as F

    data = [r for r in rows()[:-2] if r[0] is not None]
    text = [r[1] or "" for r in sorted(data, key=lambda r: r[0])]
    got = fingerprints.edited_fingerprints(frame(spark, data)).withColumn(
        "hex", fingerprints.fingerprint_hex(F.col("fp"))).orderBy("doc_id").collect()
    for i, r in enumerate(got):
        half = len(text[i]) // 2
        nxt = text[(i + 1) % len(text)]
        edited = text[i][:len(text[i]) - half] + nxt[:half]
        assert r.n_chars == len(text[i]) and r.edited == edited and r.hex == hexed(text[i])
        assert r.near_edited == pytest.approx(cosine(text[i], edited))
        assert r.near_next == pytest.approx(cosine(text[i], nxt))


def test_fingerprint_insert_delete_and_order(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("one.\ntwo.\nthree.", "three.\none.\ntwo.", "two.", "one.\nthree.")], list("abcd"))
    fp = {c: fingerprints.fingerprint(F.col(c)) for c in "abcd"}
    r = df.select((fp["a"] == fp["b"]).alias("order"), (fingerprints.remove(fp["a"], fp["c"]) == fp["d"]).alias("gone"),
                  (fingerprints.merge(fp["d"], fp["c"]) == fp["a"]).alias("back")).first()
    assert r.order and r.gone and r.back


def test_fingerprint_likeness_of_one_line_repeated_often(spark):
    data = [(1, "tick\n" * 100, "en", "a", 1), (2, "tick\n" * 20_000, "en", "a", 1), (3, "tick\n" * 12_000, "en", "a", 1)]
    got = fingerprints.edited_fingerprints(frame(spark, data)).collect()
    assert [round(r.near_next, 9) for r in got] == [1.0, 1.0, 1.0]
    assert [round(r.near_edited, 9) for r in got] == [1.0, 1.0, 1.0]


@pytest.mark.parametrize("ids", [
    [*range(60), 10 ** 15], [7] * 40 + list(range(20)), [None] * 30 + list(range(30)), [5] * 50, [None] * 10, [3]])
def test_fingerprint_next_row_whatever_the_identifiers(spark, ids):
    from pyspark.sql import functions as F

    rows_ = [(i, f"text {k % 45}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows_, "doc_id long, text string").repartition(4)
    got = fingerprints.with_next(df, "doc_id", ["text"]).withColumn("h", F.xxhash64("text")).collect()
    line = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h, r.text))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in got) == sorted(
        (i is not None, i or 0, t) for i, t in rows_)
    want = sorted((str(a.doc_id), a.text, b.text) for a, b in zip(line, line[1:] + line[:1]))
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in got) == want


def test_fingerprint_ranges_split_hot_identifiers(spark):
    from collections import Counter

    data = [(7 if k % 3 else k if k % 2 else 10 ** 15 + k, f"text {k}") for k in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    n = Counter(r.b for r in df.select(fingerprints._ranges(df, "doc_id", "text").alias("b")).collect())
    assert max(n.values()) < 3000 // 8


def test_licenses(spark):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = licenses.scan(frame(spark)).collect()
    for r in got:
        t = {x[0]: x[1] for x in rows()}[r.doc_id]
        w = word.findall((t or "").translate(LOW))
        places, labels = [], set()
        for phrase, label in licenses.BASE:
            p = phrase.split()
            found = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert {r.doc_id: r.labels for r in got}[12] == "gpl,mit"


def test_license_templates_are_found_with_small_edits(spark):
    text = "Redistribution and use, in source and binary forms, with or without any modification are permitted provided"
    data = [(1, "lorem ipsum " * 30 + text, "en", "a", 1), (2, "All rights reserved.", "en", "a", 1),
            (3, "rights all reserved", "en", "a", 1)]
    data += [(10 + i, f"plain text number {i} and use the source or the forms", "en", "a", 1) for i in range(40)]
    got = {r.doc_id: r.labels for r in licenses.scan(frame(spark, data)).collect()}
    assert got[1] == "bsd" and got[2] == "all-rights-reserved" and got[3] == "" and got[11] == ""


@pytest.mark.parametrize("text, labels", [
    ("Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("a Creative Commons Attribution-Non-Commercial-No Derivatives 3.0 license", "cc-by-nc-nd"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa"), ("CC BY 4.0", "cc-by"), ("sent cc by mail", ""),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd"), ("SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: AGPL-3.0-only", "agpl"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gpl,lgpl"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("CC BY 4.0 for the text, CC BY-NC 4.0 for the photos", "cc-by,cc-by-nc"),
])
def test_license_labels_are_the_longest_names(text, labels):
    import re

    index = licenses.Index({}, 1000)
    number = {w: i for i, w in enumerate(index.words)}
    words = [(i, number[w]) for i, w in enumerate(re.findall("[a-z0-9]+", text.lower())) if w in number]
    pos, vocab = (list(x) for x in zip(*words)) if words else ([], [])
    import numpy as np
    assert index.scan(np.array(pos), np.array(vocab))[4] == labels


def test_license_notices_of_a_long_file_are_all_found():
    import numpy as np

    # the words of the short notices are common, those of the long ones rare
    common = "all rights reserved licensed under cc by nc sa 4 0".split()
    index = licenses.Index({w: 500 for w in common}, 1000)
    number = {w: i for i, w in enumerate(index.words)}
    notices = [t for _, t, _ in licenses.TEMPLATES]
    assert len({w for t in notices for w in t.split() if number[w] in index.postings}) > 24
    at = [number[w] for t in notices for w in t.split()]
    labels = index.scan(np.arange(len(at)), np.array(at))[4]
    assert set(labels.split(",")) == {label for label, _, _ in licenses.TEMPLATES}


def test_toxicity_grammar():
    s = toxicity.Scorer({"idiot$": 2.0, "tras": 1.0})
    plain = s.clause("what an idiot", set())[0]
    assert s.clause("you idiot", set())[0] == pytest.approx(1.5 * plain)
    assert s.clause("not an idiot", set())[0] < plain / 2
    assert s.clause("he said idiot", set())[0] < s.clause("he is an idiot", set())[0]
    assert s.clause("i will kill you", set())[2] > 0 and s.clause("i kill time", set())[2] == 0
    assert s.features("")[0] == 0 and s.features("IDIOT! trashy")[0] > s.features("IDIOT!")[0]


def test_toxicity_apostrophes_and_verb_forms():
    s = toxicity.Scorer({"idiot$": 2.0})
    for straight in ("you aren't an idiot", "you don't look like an idiot", "I'll kill you", "you're an idiot"):
        assert s.features(straight.replace("'", "’")) == s.features(straight)
    assert s.features("you aren’t an idiot")[0] < s.features("you are an idiot")[0]
    for threat in ("I’m killing you tonight", "we're stabbing them", "he will be murdered, you too"):
        assert s.features(threat)[6] > 0
    assert s.features("I'm skilling up, you too")[6] == 0


def test_toxicity_reads_whole_clauses():
    s = toxicity.Scorer({"idiot$": 2.0})
    filler = "word " * 300
    for clause in (f"he said {filler}idiot", f'"{filler}idiot', f"you are {filler}idiot", f"you will {filler}kill"):
        score, hidden, threat = s.clause(clause, set())
        for text in (clause, f"First one. Second; {clause}", f"{clause}! plain end"):
            x = s.features(text)
            assert (x[0], x[5], x[6]) == pytest.approx(tuple(map(math.log1p, (score, hidden, threat))))


def test_toxicity_entry_whole_and_as_beginning():
    for lexicon in ({"scum": 1.5, "scum$": 2.0}, {"scum$": 2.0, "scum": 1.5}):
        s = toxicity.Scorer(lexicon)
        assert s.features("a scumbag")[0] == pytest.approx(math.log1p(1.5))
        assert s.features("a scum")[0] == pytest.approx(math.log1p(2.0))
    assert toxicity.Scorer({"scum$": 2.0}).features("a scumbag")[0] == 0


def test_toxicity_filter_keeps_columns(spark):
    df = clashing(frame(spark))
    out = toxicity.clean_rows(df, MODEL)
    assert out.columns == df.columns
    ids = {r.doc_id for r in out.collect()}
    assert 15 not in ids and {1, 4, 5, None} <= ids


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(frame(spark), none).weights == toxicity.DEFAULT_WEIGHTS


def thue_morse(n=1024):
    """Two words of n letters that sums over byte values take for one."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_sums_cannot_tell_apart(spark):
    x, y = thue_morse()
    rest = " ".join(f"r{i}" for i in range(49))
    data = [(1, f"{x} {rest}", "en", "a", 1), (2, f"{y} {rest}", "en", "a", 1), (3, f"{x} p q", "en", "a", 1),
            (4, f"{y} p q", "en", "a", 1), (5, f"{x}  {rest}", "en", "a", 1)]
    removed = {r.doc_id: r.n_removed for r in substrings.removal_digests(frame(spark, data)).collect()}
    assert removed == {1: 0, 2: 0, 3: 0, 4: 0, 5: 50}
    comp = {r.doc_id: r.component_id for r in near_dedup.near_groups(frame(spark, data[2:4])).collect()}
    assert comp == {3: 3, 4: 4}


def test_windows_of_equal_hashes_are_told_apart_by_words(monkeypatch):
    import numpy as np
    import pyarrow as pa

    def rows_of(*texts):
        return pa.RecordBatch.from_pydict({"m": [1] * len(texts), "doc_id": list(range(len(texts))),
                                           "row": list(range(len(texts))), "at": [0] * len(texts),
                                           "words": [t.encode() for t in texts]})
    one, two = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    monkeypatch.setattr(substrings, "_window_hashes", lambda h, g: (np.zeros(len(h) - 49, "u8"), np.zeros(len(h) - 49, "u8")))
    got = [r for b in substrings._repeated([rows_of(one, two, one.replace(" ", "\t"))]) for r in b.to_pylist()]
    assert got == [{"doc_id": 2, "row": 2, "a": 0, "b": 50}]


def test_near_rows_of_one_identifier_keep_their_own_texts(spark):
    a, b = passage(21, 60), passage(22, 60)
    data = [(3, a, "en", "a", 1), (5, a + " ", "en", "a", 1), (5, b, "en", "a", 1), (5, b + "  ", "en", "b", 1)]
    stay = Counter((r.doc_id, r.text.strip()) for r in near_dedup.near_dedup(frame(spark, data)).collect())
    assert stay == {(3, a): 1, (5, b): 2}
    groups = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_groups(frame(spark, data)).collect())
    assert groups == {(3, 3, True): 1, (5, 3, False): 1, (5, 5, True): 2}
    joined = Counter((r.doc_id, r.component_id) for r in jaccard_join.joined(frame(spark, data)).collect())
    assert joined == {(3, 3): 1, (5, 3): 1, (5, 5): 2}


def components_of(texts, k, percent):
    comp = {i: i for i in texts}
    links = [(i, j) for i in texts for j in texts if i < j and similar(texts[i], texts[j], k, percent)]
    for _ in texts:
        for i, j in links:
            comp[i] = comp[j] = min(comp[i], comp[j])
    return comp


def test_join_of_crowds_against_all_pairs(spark):
    """Crowds of near copies around the threshold, documents that share a
    common passage, chains of short texts; columns are crowded early."""
    texts = {}
    for i in range(40):   # near copies, edits from few to too many
        w = [f"k{j}" for j in range(90)]
        for e in range(i % 7):
            w[(i * 13 + e * 17) % 90] = f"x{i}_{e}"
        texts[i] = " ".join(w)
    common = passage(31, 40)
    for i in range(40, 60):
        texts[i] = f"{passage(i, 30 + 3 * i)} {common}"
    base = [f"c{j}" for j in range(120)]
    for i in range(60, 80):
        texts[i] = " ".join(base[(i - 60) * 2:(i - 60) * 2 + 40])
    for i in range(80, 90):
        texts[i] = " ".join(f"s{j}" for j in range(i - 78))
    data = [(i, t, "en", "a", 1) for i, t in texts.items()]
    got = {r.doc_id: r.component_id for r in jaccard_join.joined(frame(spark, data), crowd=3).collect()}
    assert got == components_of(texts, 5, 80)


def test_parities_never_exceed_the_difference():
    """The bound that prunes pairs holds for every pair of sets, and parts large
    crowds just below the threshold."""
    rng = np.random.default_rng(4)
    pruned = 0
    for case in range(400):
        n, swap = int(rng.integers(0, 400)), int(rng.integers(0, 60))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[swap:], rng.integers(0, 2**64, swap, dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        seen = sum(int(x).bit_count() for x in (jaccard_join.parities(a) ^ jaccard_join.parities(b)).view(np.uint64))
        assert seen <= apart and (apart - seen) % 2 == 0
        linked = 180 * len(np.intersect1d(a, b)) >= 80 * (len(a) + len(b))
        fits = 180 * seen <= 20 * (len(a) + len(b))
        assert fits or not linked
        pruned += not fits
    assert pruned > 50


def test_join_joins_components_of_best_partners(spark):
    """Pairs nearest to each other within a group that is linked as a whole, and
    a document alone that only a pair's further links reach."""
    texts = {}
    for i in range(16):
        w = [f"k{j}" for j in range(300)]
        w[(i // 2) * 30 + 5] = f"pair{i // 2}"
        w[(i // 2) * 30 + 15] = f"also{i // 2}"
        w[290 + i % 2] = "own"
        texts[i] = " ".join(w)
    texts[50] = " ".join(f"k{j}" for j in range(250))
    texts[51] = texts[50].replace("k100 ", "other ")
    got = {r.doc_id: r.component_id for r in jaccard_join.joined(frame(spark, [(i, t, "en", "a", 1) for i, t in texts.items()])).collect()}
    assert got == components_of(texts, 5, 80) and set(got.values()) == {0, 50}


def term_rows(data):
    return [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOW)))
            for _, t, l, s, _ in data]


def divergence_by_hand(data, least):
    rows = term_rows(data)
    out = Counter()
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df, total = Counter(), Counter()
        for _, _, w in mine:
            df.update(set(w))
            total.update(w)
        kept = sorted((t for t in df if df[t] >= least), key=lambda t: t.encode())
        groups = {}
        for _, s, w in mine:
            groups.setdefault(s, Counter()).update(x for x in w if df[x] >= least)
        p = {s: {t: 1 + (10**9 * (c[t] + 5)) // (sum(c.values()) + 5 * len(kept)) for t in kept} for s, c in groups.items()}
        n = sum(total[t] for t in kept)
        q = {t: 1 + (10**9 * (total[t] + 5)) // (n + 5 * len(kept)) for t in kept}
        for s, c in groups.items():
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found, top in (("pair", pair, None), ("term", term, 50)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (v, item) in enumerate(found[:top], 1):
                    out[lang, s, part, item, v, rank] += 1
    return out


def test_divergence_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_ROWS", 40)
    monkeypatch.setattr(divergence, "BUCKET_BYTES", 5_000)
    words = ["Alpha", "be", "ab", "gämma", "x" * 8, "x" * 9, "y" * 16, "y" * 17, "ÄÖ" * 40, "z" * 300, "z" * 301, "abcdefgh", "abcdefghi"]
    data = rows() + [(100 + i, " ".join(words[(i * j) % len(words)] for j in range(1, 9)) + f" only{chr(97 + i % 5)}",
                      ("en", "de", None)[i % 3], f"s{i % 5}" if i % 11 else None, 1) for i in range(120)]
    got = Counter(tuple(r) for r in divergence.divergence(clashing(frame(spark, data)), min_docs=4, tile=2).collect())
    assert got == divergence_by_hand(data, 4)
    assert divergence.divergence(frame(spark, [])).count() == 0


def test_terms_are_packed_and_sorted_as_bytes():
    import numpy as np

    rng = np.random.RandomState(5)
    a, b = (rng.randint(0, 1 << 40, 3000).astype("u8") % np.uint64(m) for m in (1 << 33, 50))
    assert packed_terms.radix_order([b, a]).tolist() == np.lexsort((a, b)).tolist()
    words = [b"abcdefgh", "ÄÖÜäöüß".encode(), b"a", b"abcdefghijklmnop"]
    block = divergence.tokenised([b" ".join(words[:1] + words[2:3])], divergence.TERM)
    assert packed_terms.unpack(packed_terms.pack(block, np.arange(2), 1)) == [words[0], words[2]]


def collocations_by_hand(data, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang, _, _ in data:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = Counter()
    for lang, c in f.items():
        found = []
        for ph, a in c.items():
            if len(ph) < 2 or a < least:
                continue
            if any(len(x) == 3 and len(ph) == 2 and v >= least and 100 * v >= 50 * a and ph in (x[:2], x[1:]) for x, v in c.items()):
                continue
            s, k = min((10**6 * a * a // (c[ph[:k]] * c[ph[k:]]), k) for k in range(1, len(ph)))
            found.append((-s, -a, " ".join(ph).encode(), c[ph[:k]], c[ph[k:]]))
        for rank, (s, a, ph, l, r) in enumerate(sorted(found)[:top], 1):
            out[lang, rank, ph.decode(), -a, l, r, n[lang], -s] += 1
    return out


@pytest.mark.parametrize("hot", [500_000, 30, 3])
def test_collocations_against_plain_python(spark, monkeypatch, hot):
    monkeypatch.setattr(phrases, "BUCKET", 300)
    words = ["the", "of", "a\x00", "naïve", "Ärger", "x" * 70, "b", "c", "d"]
    data = rows() + [(100 + i, " ".join(words[(i * j + j * j) % (3 + i % 7)] + ("." if (i + j) % 5 == 0 else "") for j in range(25)),
                      ("en", "de", None)[i % 3], "s", 1) for i in range(60)]
    got = Counter(tuple(r) for r in phrases.collocations(clashing(frame(spark, data)), least=3, top=40, hot_above=hot).collect())
    assert got == collocations_by_hand(data, 3, 40)


def test_frequent_prefixes_against_counting():
    import numpy as np

    rng = np.random.RandomState(3)
    words = rng.zipf(1.3, (30_000, 3)) % 40
    words[rng.rand(30_000) < 0.1, 2] = -1
    words[rng.rand(30_000) < 0.05, 1:] = -1
    n = rng.randint(1, 4, 30_000)
    want = Counter()
    for w, k in zip(words.tolist(), n.tolist()):
        for size in (2, 3):
            if -1 not in w[:size]:
                want[tuple(w[:size])] += k
    for least in (1, 50):
        got = Counter()
        for r, size, count in phrases.frequent_prefixes(words, n, least):
            for i, c in zip(r, count):
                got[tuple(words[i, :size].tolist())] += int(c)
        assert got == Counter({k: v for k, v in want.items() if v >= least})


def test_collocations_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
