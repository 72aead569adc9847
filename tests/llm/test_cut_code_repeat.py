"""Fill-in-middle, vector codes and suffix-array dedup against brute force, on small tables with odd rows."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftkit.llm import fill_in_middle as fim
from shiftkit.llm import suffix_dedup, vector_codes
from shiftkit.llm.suffix_array import permuted_lcp, suffix_array

DOCS = "doc_id long, text string, lang string, n long, form string, label int, spans string, kept string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, "f", 1, "s", "k") for i, t in rows], DOCS)


def sha(b):
    return hashlib.sha256(b).hexdigest()


# --- fill in the middle -------------------------------------------------------

def fim_model(doc_id, text):
    t = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    n = len(tokens)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    rng = np.random.default_rng(3)
    signs = list("ab Z\n\t09é߿ࠀ漢😀𝔸<>PSM") + ["word", "<P", "S>", "\u0000"]
    rows = [(i, "".join(rng.choice(signs, rng.integers(1, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " "), (203, "a"), (204, "é"), (205, "x<S>y" * 9), (206, "<M>"), (None, "ein Wörtchen"), (None, None),
             (207, "abc déf " * 40_000), (207, "abc déf " * 40_000), (-5, "negative ids too"), (208, "😀" * 3_000)]
    return rows


def test_fill_in_middle_agrees_with_strings(spark):
    rows = fim_rows()
    out = fim.transformed(table(spark, rows)).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted(((i, *fim_model(i, t), t or "") for i, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_by_code_points(spark):
    rows = [r for r in fim_rows() if r[1] and len(r[1]) < 4_000]
    for r in fim.transformed(table(spark, rows), unit="code points").collect():
        if r.form != "plain":
            h = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
            a, b = sorted(int(h[8 * i:8 * i + 8], 16) % (r.n + 1) for i in range(2))
            assert (r.prefix_chars, r.prefix_chars + r.middle_chars) == (a, b)
    with pytest.raises(ValueError):
        fim.transformed(table(spark, rows), unit="bytes")


def test_exception_index_converts_both_ways():
    text = "añ😀z漢" * 50 + "plain"
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.Exceptions(data)
    chars = np.arange(len(text) + 1)
    bytes_ = np.array([len(text[:i].encode()) for i in chars])
    assert (index.to_bytes(chars) == bytes_).all() and (index.to_code_points(bytes_) == chars).all()
    assert len(index.at) == 150                              # only multibyte characters are stored
    empty = fim.Exceptions(np.zeros(0, np.uint8))
    assert empty.to_code_points(np.array([0]))[0] == 0


def test_fill_in_middle_of_nothing(spark):
    assert fim.transformed(table(spark, [])).count() == 0


# --- vector codes -------------------------------------------------------------

def code_model(rows, rounds=2):
    """(vec_id, label, code, error), digest by plain integers."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = len(kept[0][1])
    width = -(-dim // 16)
    ints = [[math.floor(256 * x) if abs(x) < 1e15 else 256 * int(x) for x in v] + [0] * (width * 16 - dim) for _, v, _ in kept]
    parts = [[x[p * width:(p + 1) * width] for p in range(16)] for x in ints]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0))
    book = [[parts[i][p] for i in order[:64]] for p in range(16)]

    def nearest(x, entries):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in entries]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(16):
            at = [nearest(x[p], book[p])[0] for x in parts]
            book[p] = [[sum(c) // len(mine) for c in zip(*mine)] if (mine := [x[p] for x, k in zip(parts, at) if k == j]) else e
                       for j, e in enumerate(book[p])]
    done = [[nearest(x[p], book[p]) for p in range(16)] for x in parts]
    rows = [(i, lab, "".join(f"{k:02x}" for k, _ in d), sum(e for _, e in d)) for (i, _, lab), d in zip(kept, done)]
    return rows, sha(",".join(str(x) for p in book for e in p for x in e).encode())


def vectors(n, dim, scale=1.0, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 2 + 1, dim)) * scale
    return [(int(i), [float(x) for x in base[i // 2] + (i % 2) * (i % 3) * 0.01 * scale], [0, 1, None][i % 3]) for i in range(n)]


ODD = [(900, None, 0), (901, [0.5, float("nan")], 1), (902, [0.1] * 16 + [float("inf")] * 16, None), (903, [None] * 32, 1)]


@pytest.mark.parametrize("dim,scale,kind", [(32, 1.0, "float"), (32, 1.0, "double"), (20, 5.0, "double"), (16, 1e9, "double"), (32, 1e30, "double")])
def test_vector_codes_agree_with_plain_integers(spark, dim, scale, kind):
    rows = vectors(90, dim, scale)
    if kind == "float":
        rows = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    rows += [(i, v, lab) for i, v, lab in ODD] + [rows[7]]                    # a row repeated after the 64 smallest ids' content
    rows = [r for r in rows if r[1] is None or len(r[1]) == dim or r[0] >= 900]
    df = spark.createDataFrame([(i, v, lab, "c", "e") for i, v, lab in rows], f"vec_id long, embedding array<{kind}>, label int, code string, error string")
    want, digest = code_model(rows)
    coded = vector_codes.compressed(df.repartition(5))
    got = coded.collect()
    big = lambda e: e if e < 1 << 63 else None
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got), key=repr) == sorted(((i, lab, c, big(e)) for i, lab, c, e in want), key=repr)
    assert {r.codebooks_sha256 for r in got} == {digest}
    sums = {}
    for _, lab, _, e in want:
        sums.setdefault(lab, []).append(e)
    for r in vector_codes.with_label_error(coded).collect():
        total = sums[r.label]
        assert r.label_error == (sum(total) if max(total) < 1 << 63 and sum(total) < 1 << 63 else None)


def test_vector_codes_ties_few_rows_dimensions_and_null_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    same = [(i, [0.25] * 16, 1) for i in range(5)]
    out = vector_codes.compressed(spark.createDataFrame(same, schema)).collect()
    assert {(r.code, r.error) for r in out} == {("00" * 16, 0)}               # ties go to the first entry
    mixed = [*same, (9, [1.0] * 32, 2), (None, [-0.5] * 16, None), (10, [], 2)]
    out = {r.vec_id: r for r in vector_codes.compressed(spark.createDataFrame(mixed, schema)).collect()}
    assert len(out) == 8 and out[9].error == 0 and out[10].error == 0 and out[None].code == "05" * 16
    assert out[9].codebooks_sha256 != out[0].codebooks_sha256
    assert vector_codes.compressed(spark.createDataFrame([], schema)).count() == 0
    assert vector_codes.with_label_error(vector_codes.compressed(spark.createDataFrame([], schema))).count() == 0


def test_limb_products_are_exact():
    rng = np.random.default_rng(1)
    for top in (1 << 8, 1 << 28, 1 << 40):
        x, e = (rng.integers(-top, top, (3, n, 7)) for n in (20, 9))
        wide = top > 1 << 28
        assert (vector_codes.exact_products(x, e, wide) == np.matmul(x.astype(object), e.swapaxes(1, 2).astype(object))).all()
    col = rng.integers(-(1 << 50), 1 << 50, 30)
    parts = vector_codes.signed_limbs(col, 20)
    assert (sum(p.astype(np.int64) << (20 * i) for i, p in enumerate(parts)) == col).all()


# --- suffix arrays and repeats -------------------------------------------------

def test_suffix_array_and_permuted_prefixes():
    rng = np.random.default_rng(2)
    cases = [rng.integers(0, k, n) for k in (1, 2, 3, 255) for n in (0, 1, 2, 17, 60)]
    cases += [np.repeat(rng.integers(0, 3, 30), rng.integers(1, 9, 30)) for _ in range(30)] + [np.tile(rng.integers(0, 2, 11), 9), np.array([5] * 300)]
    for t in cases:
        b = t.astype(np.uint8).tobytes()
        sa = suffix_array(t)
        assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])  # noqa: B023
        lcp = permuted_lcp(t.astype(np.uint8), sa)
        for x, y in zip(sa[:-1], sa[1:]):
            n = 0
            while max(x, y) + n < len(b) and b[x + n] == b[y + n]:
                n += 1
            assert lcp[y] == n


def repeats_model(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for j in range(len(b) - length + 1):
            w = b[j:j + length]
            first[w] = min(first.get(w, math.inf), math.inf if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if first[b[j:j + length]] < (math.inf if i is None else i):
                gone[j:j + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, len(b), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def repeat_rows():
    rng = np.random.default_rng(5)
    word = lambda n: " ".join("".join(rng.choice(list("abcdeé"), 6)) for _ in range(n))
    shared, edge = word(30), word(7)[:50]
    rows = [(i, f"{word(int(rng.integers(0, 12)))} {shared[int(rng.integers(0, 40)):]} {word(int(rng.integers(0, 12)))}") for i in range(60)]
    rows += [(100, shared), (101, shared), (101, shared), (100, word(20)), (102, rows[3][1]), (103, edge), (104, "x" + edge + "y"), (105, edge[:-1]),
             (106, "a" * 400), (107, "b" + "a" * 120), (108, "漢字かな" * 40), (109, "z" + "漢字かな" * 30), (110, None), (111, ""), (112, " "),
             (None, shared), (None, shared), (-7, shared[20:90]), (113, word(3_000)), (114, "tail " * 4_000), (115, "tail " * 3_000)]
    return rows


def found(df):
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block,hot", [(4 << 20, 20_000), (3_000, 20_000), (3_000, 3), (200, 0)])
def test_repeats_agree_with_a_dictionary(spark, block, hot):
    rows = repeat_rows()
    got = found(suffix_dedup.without_repeats(table(spark, rows).repartition(3), block=block, hot=hot))
    assert got == sorted(repeats_model(rows), key=repr)


def test_repeats_of_other_lengths_and_nothing(spark):
    rows = repeat_rows()[:30]
    assert found(suffix_dedup.without_repeats(table(spark, rows), length=30)) == sorted(repeats_model(rows, 30), key=repr)
    assert suffix_dedup.without_repeats(table(spark, [])).count() == 0
    assert found(suffix_dedup.without_repeats(table(spark, [(1, None), (2, "")]))) == [(1, 0, [], b""), (2, 0, [], b"")]
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(table(spark, rows), length=23)


def test_repeat_query_digests(spark):
    out = suffix_dedup.op13_suffix_dedup(spark, "/root/testdata/sf0.001")
    want = repeats_model([(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()])
    assert sorted(map(tuple, out.collect())) == sorted((i, n, sum(e - s for s, e in sp), len(sp), sha(k)) for i, n, sp, k in want)
