"""Source divergence, exact vector search and phrase mining against brute force and on awkward input."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import collocations, divergence, va_file
from sluice.llm.common import table

DOCS = "doc_id long, text string, lang string, source string"
CLASHING = "n int, docs int, first int, term string, key string, `odd.name` int"


def docs_of(spark, rows):
    """Rows with extra columns named like those the operators use."""
    return spark.createDataFrame([(*r, 1, 2, 3, "x", "y", 4) for r in rows], f"{DOCS}, {CLASHING}")


def awkward(seed=3, docs=120, words=("alpha", "Beta", "GAMMA", "élan", "x1y", "été", "d-e", "zeta")):
    """Nulls, empty and repeated rows, a hot source, a long text, words of all kinds."""
    rng = random.Random(seed)
    rows = []
    for k in range(docs):
        lang = rng.choice(["en", "en", "de", "", None])
        source = rng.choice(["hot", "hot", "a", "b", None, ""])
        count = rng.choice([0, 1, 3, 20])
        rows.append((k, rng.choice([" ", "  ", ". ", "\t"]).join(rng.choice(words) for _ in range(count)), lang, source))
    rows += [rows[5], rows[5], (None, None, "en", "empty"), (7, "", "xx", "only"), (8, "once", "yy", None), (9, None, None, None)]
    rows.append((10, " ".join(rng.choice(words) for _ in range(60_000)), "en", "hot"))
    return rows


# -- divergence ------------------------------------------------------------


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_audit(rows, ranks=200):
    seen, groups, frequency = defaultdict(Counter), defaultdict(set), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = Counter(plain_terms(text))
        seen[lang, source].update(found)
        frequency[lang].update(found.keys())
    result = []
    for lang, sources in groups.items():
        kept = [t for t, n in frequency[lang].items() if n >= 3]

        def probabilities(counts):
            size = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (size + len(kept)) for t in kept}

        p = {s: probabilities(seen[lang, s]) for s in sources}
        q = probabilities(sum((seen[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if seen[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                result += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:most], 1)]
    return sorted(result)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_divergence_equals_brute_force(spark):
    rows = awkward()
    assert rows_of(divergence.audit(docs_of(spark, rows))) == plain_audit(rows)


def test_divergence_cuts_term_ranks_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    rows = awkward(4)
    assert rows_of(divergence.audit(docs_of(spark, rows), ranks=2)) == plain_audit(rows, 2)


def test_terms_split_at_every_ascii_separator():
    text = "".join(map(chr, range(256))) + "Ünï côde A_b"
    assert [t.decode() for t in divergence.terms(text.encode())] == plain_terms(text)


def test_probability_is_exact_for_large_counts(spark):
    frame = spark.createDataFrame([(2**47, 2**48, 12_345), (0, 0, 1), (3, 10**12, 7)], "n long, size long, kept long")
    got = frame.select("*", divergence.probability(F.col("n"), F.col("size"), F.col("kept")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 1) // (r["size"] + r["kept"]) for r in got)


def test_divergence_of_nothing(spark):
    docs = docs_of(spark, awkward())
    assert divergence.audit(docs.filter("false")).collect() == []
    lonely = docs_of(spark, [(1, None, "en", "a"), (2, "word", "en", "b")])
    assert rows_of(divergence.audit(lonely)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


# -- vectors ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, key string, ints int, members int, id int, `odd.name` int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k", 1, 2, 3, 4) for i, v in rows], VECTORS)


def plain_top(rows, k):
    """Best rows of each query, each row apart from all others."""
    ints = []
    for vec_id, vector in rows:
        if vector is not None and all(x is not None and abs(x) < float("inf") for x in vector):
            ints.append((vec_id, [int(x * 64 // 1) for x in vector]))
    result = []
    for at, (query, q) in enumerate(ints):
        if query is not None and query % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(q, c)), i is None, i) for n, (i, c) in enumerate(ints) if n != at]
            scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
            result += [(query, rank, i, -cost) for rank, (cost, _, i) in enumerate(scored[:k], 1)]
    return Counter(result)


def awkward_vectors(seed=1, count=300, width=7):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0, 0.4) for _ in range(width)]) for k in range(count)]
    rows += [(1_000 + k, rows[40][1]) for k in range(60)]  # a large group of copies, queries among them
    rows += [(2_000 + k, [0.0] * width) for k in range(50)]
    nan, infinity = float("nan"), float("inf")
    rows += [(20, rows[20][1]), (20, rows[21][1]), (None, rows[0][1]), (None, None), (40, None), (60, [nan] * width)]
    rows += [(80, [infinity] * width), (3, [None] + [1.0] * (width - 1)), (100, [1.0]), (120, []), (140, [0.25] * (width + 5))]
    return rows


@pytest.mark.parametrize("round_components", [va_file.ROUND_COMPONENTS, 60])
def test_nearest_vectors_equal_brute_force(spark, monkeypatch, round_components):
    monkeypatch.setattr(va_file, "ROUND_COMPONENTS", round_components)
    monkeypatch.setattr(va_file, "BLOCK_BOUNDS", 500)
    rows = awkward_vectors(count=120 if round_components == 60 else 300)
    for k in (5, 20) if round_components != 60 else (3,):
        got = Counter(tuple(r) for r in va_file.top_k(vectors_of(spark, rows), k).collect())
        want = plain_top(rows, k)
        # Rows of one id and one score are alike; which of them stands where is no difference.
        assert got == want


def test_large_components_are_exact(spark):
    """Products beyond 53 bits: bounds in floating point are widened, scores are integers."""
    rng = random.Random(2)
    rows = [(k, [float(rng.randrange(-(2**23), 2**23)) for _ in range(4)]) for k in range(60)]
    got = va_file.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 4)
    assert Counter(tuple(r) for r in got.collect()) == plain_top(rows, 4)


def test_scores_are_cut_off_at_64_bits():
    large = np.array([[2**62, 2**62], [2**62, 1], [-(2**62), 3]])
    assert va_file.exact_products(large, np.array([[2, 2], [1, 5], [2, 1]])).tolist() == [2**63 - 1, 2**62 + 5, -(2**63) + 3]


def test_cells_bound_their_components(spark):
    rows = vectors_of(spark, awkward_vectors()).select("vec_id", va_file.integers("embedding").alias("ints"))
    found = rows.filter("ints is not null").select(F.xxhash64("ints").cast("string").alias("key"), "ints")
    marks = va_file.measure(found)
    ints = va_file._matrix(found.toArrow()["ints"].combine_chunks(), len(marks.low))
    cells = va_file.unpack(va_file.pack(marks.cells(ints)), ints.shape[1])
    for d in range(ints.shape[1]):
        assert (marks.low[d][cells[:, d]] <= ints[:, d]).all() and (ints[:, d] <= marks.high[d][cells[:, d]]).all()
    assert len(set(map(tuple, cells.tolist()))) > 50


def test_pruning_reads_few_exact_vectors(spark):
    """Of 2000 vectors in eight dimensions, the scan leaves a small share to read."""
    rng = random.Random(9)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(8)]) for k in range(2_000)]
    found = va_file.classes(
        vectors_of(spark, rows).select(
            F.unhex(F.sha2(F.to_json(va_file.integers("embedding")), 256)).alias("key"),
            va_file.integers("embedding").alias("ints"),
            F.col("vec_id").alias("id"),
            F.lit(0).cast("long").alias("__row_file"),
            F.col("vec_id").alias("__row_at"),
        ),
        6,
    )
    marks = va_file.measure(found)
    queries = va_file._matrix(found.limit(10).toArrow()["ints"].combine_chunks(), 8)
    bounds = va_file.Bounds(queries, marks)
    packed = va_file.approximate(found, marks).toArrow()["cells"].combine_chunks()
    lower = [bounds.lower(*b) for b in bounds.blocks(packed)]
    upper = [bounds.upper(*b) for b in bounds.blocks(packed)]
    assert len(lower) == 1
    assert (upper[0][0] >= sorted(lower[0][0])[-5]).sum() < 400


def test_no_vectors(spark):
    frame = vectors_of(spark, awkward_vectors())
    assert va_file.top_k(frame.filter("false")).collect() == []
    assert va_file.top_k(frame.filter("embedding is null")).collect() == []
    assert va_file.top_k(vectors_of(spark, [(7, [1.0])])).collect() == []
    empty = vectors_of(spark, [(20, []), (1, []), (2, [])])
    assert rows_of(va_file.top_k(empty)) == [(20, 1, 1, 0), (20, 2, 2, 0)]


# -- phrases ---------------------------------------------------------------


def plain_collocations(rows, least, ranks):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, 6):
                for start in range(len(words) - size + 1):
                    counts[lang][tuple(words[start : start + size])] += 1
    result = []
    for lang, found in counts.items():
        frequent = {p: n for p, n in found.items() if n >= least}
        inside = Counter()
        for phrase, f in frequent.items():
            for start, end in combinations(range(len(phrase) + 1), 2):
                if end - start < len(phrase):
                    inside[phrase[start:end]] = max(inside[phrase[start:end]], f)
        scored = []
        for phrase, a in frequent.items():
            if len(phrase) > 1 and inside[phrase] < a:
                cuts = []
                for k in range(1, len(phrase)):
                    left, right = frequent[phrase[:k]], frequent[phrase[k:]]
                    cuts.append((1000 * a * sizes[lang] // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:ranks], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(result)


def phrase_rows(seed=5):
    rng = random.Random(seed)
    words = ["the", "of", "Strong", "TEA", "été", "a\x01b", "a", "#x", "it's", "\x00"]
    rows = []
    for k in range(150):
        text = ""
        for _ in range(rng.randrange(12)):
            text += rng.choice(["the of the of the of", "strong tea", "a strong tea of the", rng.choice(words), "rare%d" % rng.randrange(10**6)])
            text += rng.choice([" ", "\t", "  ", ". ", ",", "\n", "\x0b", ":;", " ! "])
        rows.append((k, text, rng.choice(["en", "en", "de", None, "und", ""]), "s"))
    return rows + [rows[3]] * 3 + [(None, None, None, None), (1, "", "fr", "s"), (2, " the of " * 4_000, "en", "s")]


@pytest.mark.parametrize("budget", [collocations.BUDGET, 40])
def test_collocations_equal_brute_force(spark, monkeypatch, budget):
    """With a budget of 40 suffixes many prefixes grow."""
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 500)
    monkeypatch.setattr(collocations, "PART_BYTES", 300)
    monkeypatch.setattr(collocations, "SHARES", 10**9)
    rows = phrase_rows()
    got = collocations.collocations(docs_of(spark, rows), least=8, ranks=40, budget=budget)
    assert rows_of(got) == plain_collocations(rows, 8, 40)


def test_full_bitmaps_only_let_more_through(spark, monkeypatch):
    chunk = b"\xff" * 4_096
    monkeypatch.setattr(collocations, "bitmap", lambda phrases: collocations.Bitmap({0: chunk}, collocations.CHUNK_BITS))
    rows = phrase_rows(6)
    got = collocations.collocations(docs_of(spark, rows), least=8, ranks=10_000)
    assert rows_of(got) == plain_collocations(rows, 8, 10_000)


def test_bitmap_holds_its_phrases(spark):
    phrases = [("en", f"w{k} été") for k in range(5_000)]
    held = collocations.bitmap(spark.createDataFrame(phrases, "lang string, phrase string"))


    def inside(found):
        marks = np.array([collocations._mark(lang.encode(), phrase.encode()) for lang, phrase in found])
        return collocations.holds(held.bytes(), marks).sum()

    assert inside(phrases) == len(phrases)
    assert inside([("en", f"other{k}") for k in range(5_000)]) < 300
    small = collocations.bitmap(spark.createDataFrame(phrases, "lang string, phrase string"), most=1 << 15)
    assert small.bits == 1 << 15 and sum(map(len, small.chunks.values())) <= 4_096


def test_subtrees_sum_their_leaves():
    leaves = [("en", "a b ", "a b ", 2), ("en", "a b ", "a b c ", 3), ("en", "a b ", "a b d e f ", 1), ("en", "b a c ", "b a c ", 9)]
    nodes = list(collocations.subtrees(((lang, p.encode(), s.encode(), f) for lang, p, s, f in leaves), 3))
    assert nodes == [("en", b"a b c", 3), ("en", b"a b", 6), ("en", b"b a c", 9), ("en", b"b a", 9)]


def test_pairs_are_counted_by_number(spark):
    texts = pa.RecordBatch.from_pydict({"lang": ["en", "en", "de"], "text": [b"a b a b", b"a b. a", b"a b"]})
    every = collocations.Bitmap({0: b"\xff" * (collocations.CHUNK_BITS // 8)}, collocations.CHUNK_BITS)
    rows = [row for batch in collocations._count_pairs(every)(iter([texts])) for row in batch.to_pylist()]
    assert sorted(row["f"] for row in rows) == [1, 1, 3]  # b a; a b in German; a b
    assert len({row["mark"] for row in rows}) == 3
    marks = spark.createDataFrame([(row["mark"],) for row in rows[:2]], "mark long")
    found = collocations.holds(collocations.bitmap(marks, each=1 << 20).bytes(), np.array([row["mark"] for row in rows]))
    assert found.tolist() == [True, True, False]


@pytest.mark.parametrize("width", [3, 13, 17, 30, 40])
def test_distinct_rows_of_any_width(width):
    draw = np.random.default_rng(width)
    columns = [draw.integers(-1, 2, 400) * ((1 << width) // 4) for _ in range(5)]
    columns = [np.where(c < 0, -1, c) for c in columns]
    _, first, counts = np.unique(np.stack(columns, axis=1), axis=0, return_index=True, return_counts=True)
    got = collocations.distinct_rows(columns, width)
    assert dict(zip(*(part.tolist() for part in got))) == dict(zip(first.tolist(), counts.tolist()))


def test_collocations_of_nothing(spark):
    docs = docs_of(spark, phrase_rows())
    assert collocations.collocations(docs.filter("false")).collect() == []
    assert collocations.collocations(docs, least=10**6).collect() == []


def test_words_of_all_tables_match_their_pattern(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang", "source").collect()]
    for _, text, _, _ in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        pieces = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]
        plain = [w for p in pieces if p for w in p]
        assert [w.decode() for part in collocations.parts((text or "").encode()) for w in part if w != b"."] == plain
