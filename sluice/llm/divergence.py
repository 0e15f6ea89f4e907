"""How the vocabulary of a source differs from the other sources of its language.

Texts are tokenized by a translate table: one ``bytes.translate`` lowers the
ASCII letters and blanks every separator, ``bytes.split`` gives the terms, and a
``Counter`` per document gives its frequencies, from which a task sums
occurrences and documents per term and group. Only those sums are shuffled.

Each group (language and source) is compared with every other source of its
language over the terms kept there, by integer arithmetic alone. A term that a
group lacks has one probability for the whole group, so the sum over all kept
terms needs no row for it: with ``f`` the divergence of a term, ``p0`` and
``q0`` the probabilities of absent terms, it is

* ``f(p, q0)`` over the terms of the one group, from a histogram of its counts,
* ``f(p0, q)`` over the terms of the other, likewise,
* ``f(p0, q0)`` for each kept term less those of both groups,
* and, for terms that both have, ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)``.

Only the last part joins rows of the same term, at most one of each source.

Defined cases: null texts, languages and sources count as ''; empty texts have
no terms, but their group occurs; repeated rows count each; a language with no
kept term has pairs with value 0 and no term rows; an empty table has no rows;
extra columns are not read. Long texts are held one at a time by a task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import as_bytes, join_key, materialise

LEAST_DOCS = 3
TERM_RANKS = 200
SCALE = 1_000_000_000

# Entries that a task holds before it hands them on.
HELD_TERMS = 200_000


def translate_table() -> bytes:
    """Lowers A-Z, keeps a-z and all bytes beyond ASCII, and blanks the rest."""
    table = bytearray(b" " * 128) + bytearray(range(128, 256))
    for letter in range(26):
        table[ord("A") + letter] = table[ord("a") + letter] = ord("a") + letter
    return bytes(table)


def terms(text: bytes, table: bytes = translate_table()) -> list[bytes]:
    return text.translate(table).split()


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(text, lang, source)`` to partial sums per group and term."""
    table = translate_table()
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in seen.items():
            names = pa.array(list(occurrences), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(names), pa.string()),
                    pa.array([source] * len(names), pa.string()),
                    names,
                    pa.array(occurrences.values(), pa.int64()),
                    pa.array([documents[t] for t in occurrences], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        seen.clear()

    for batch in batches:
        texts, langs, sources = batch.columns
        for text, lang, source in zip(texts, langs, sources):
            document = Counter(terms(text.as_py(), table))
            occurrences, documents = seen[lang.as_py(), source.as_py()]
            occurrences.update(document)
            documents.update(document.keys())
            if sum(len(o) for o, _ in seen.values()) > HELD_TERMS:
                yield from flush()
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of a term in a group."""
    rows = _groups_of(docs).select(as_bytes("text").alias("text"), "lang", "source")
    partial = rows.mapInArrow(_tally, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _groups_of(docs: DataFrame) -> DataFrame:
    return docs.select("text", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")))


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Counts of the terms in at least ``least_docs`` documents of their language, written out.

    ``lang_n`` is the term's count in the language; ``first`` is 1 in one row of each term.
    """
    term = Window.partitionBy("lang", "term")
    counted = term_counts(docs).withColumns(
        {
            "first": (F.row_number().over(term.orderBy("source")) == 1).cast("int"),
            "lang_n": F.sum("n").over(term),
            "lang_docs": F.sum("docs").over(term),
        }
    )
    return materialise(counted.filter(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs"), "kept-terms")


def probability(n: Column, size: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (size + kept))``, exact for counts up to 2 ** 48.

    The factor is applied in two steps, so that no product leaves 64 bits.
    """
    first, second = 31_250, 32_000
    assert first * second == SCALE
    whole = size + kept
    scaled = (n + 1) * F.lit(first)
    quotient = F.call_function("div", scaled, whole)
    return F.lit(1) + quotient * F.lit(second) + F.call_function("div", scaled % whole * F.lit(second), whole)


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q) ** 2 / q)``."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every occurring group with its sums, and its language's, over kept terms; written out, a row for each group.

    ``absent`` is the probability of a term that the group lacks, null where the language keeps no term.
    """
    groups = _groups_of(docs).select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count("*").alias("present"), F.sum("first").alias("firsts"))
    lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    sized = groups.join(sums, ["lang", "source"], "left").select(
        "lang",
        "source",
        F.coalesce("size", zero).alias("size"),
        F.coalesce("present", zero).alias("present"),
        F.coalesce(F.sum("firsts").over(lang), zero).alias("kept"),
        F.coalesce(F.sum("size").over(lang), zero).alias("lang_size"),
    )
    absent = F.when(F.col("kept") > 0, probability(zero, F.col("size"), F.col("kept")))
    return materialise(sized.withColumn("absent", absent), "group-sizes", files=1)


def _term_rows(kept: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    rows = kept.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        probability(F.col("n"), F.col("size"), F.col("kept")).alias("p"),
        probability(F.col("lang_n"), F.col("lang_size"), F.col("kept")).alias("q"),
    )
    rows = rows.filter("p > q").select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    return _ranked(rows, "term").filter(F.col("rank") <= ranks)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumns({"part": F.lit(part), "rank": F.row_number().over(order)})


def _side(groups: DataFrame, suffix: str) -> DataFrame:
    names = ("source", "size", "present", "absent")
    return groups.select("lang", "kept", *(F.col(c).alias(c + suffix) for c in names))


def _pair_rows(kept: DataFrame, groups: DataFrame) -> DataFrame:
    pairs = _side(groups, "_a").join(_side(groups, "_b").drop("kept"), "lang").filter("source_a <> source_b")

    # Terms that neither group has, short of those that both have.
    absent = F.col("kept") - F.col("present_a") - F.col("present_b")
    base = pairs.select("lang", "source_a", "source_b", F.coalesce(absent * divergence(F.col("absent_a"), F.col("absent_b")), F.lit(0)).alias("value"))

    # Terms of one group against the other's absent terms, by how often they occur.
    histogram = kept.groupBy("lang", F.col("source").alias("source_a"), "n").agg(F.count("*").alias("terms"))
    met = histogram.join(pairs, ["lang", "source_a"]).withColumn("p", probability(F.col("n"), F.col("size_a"), F.col("kept")))
    met = met.groupBy("lang", "source_a", "source_b").agg(
        F.sum(F.col("terms") * divergence(F.col("p"), F.col("absent_b"))).alias("forth"),
        F.sum(F.col("terms") * divergence(F.col("absent_b"), F.col("p"))).alias("back"),
    )

    # Terms of both groups, each pair of sources once. The counts grow with the corpus: they are shuffled, never broadcast;
    # what a group adds to its counts comes before, so that pairs of rows are summed where they meet.
    known = kept.join(groups, ["lang", "source"]).withColumn("p", probability(F.col("n"), F.col("size"), F.col("kept")))
    key = join_key("lang", "term").alias("key")
    sides = [known.select(key, "lang", *(F.col(c).alias(c + s) for c in ("source", "p", "absent"))) for s in ("_a", "_b")]
    both = sides[0].hint("merge").join(sides[1].drop("lang"), "key").filter("source_a < source_b")

    def shared(one: str, other: str) -> Column:
        p, q, p0, q0 = (F.col(c) for c in ("p_" + one, "p_" + other, "absent_" + one, "absent_" + other))
        return divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0)

    both = both.groupBy("lang", "source_a", "source_b").agg(F.sum(shared("a", "b")).alias("forth"), F.sum(shared("b", "a")).alias("back"))

    directed = F.inline(
        F.array(
            F.struct(F.col("source_a"), F.col("source_b"), F.col("forth").alias("value")),
            F.struct(F.col("source_b").alias("source_a"), F.col("source_a").alias("source_b"), F.col("back").alias("value")),
        )
    )
    parts = base.unionByName(met.select("lang", directed)).unionByName(both.select("lang", directed))
    rows = parts.groupBy("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item")).agg(F.sum("value").alias("value"))
    return _ranked(rows, "pair")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = TERM_RANKS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair`` has each other source of the language with the divergence
    from it, part ``term`` the group's ``ranks`` most over-used terms against
    its language. Ranks are by value descending, then item.
    """
    kept = kept_terms(docs, least_docs)
    groups = group_sizes(docs, kept)
    found = _pair_rows(kept, groups).unionByName(_term_rows(kept, groups, ranks))
    return found.select("lang", "source", "part", "item", "value", "rank")
