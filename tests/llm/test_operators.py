"""The text operators on small fixtures, against brute force and on awkward input."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import decontaminate, factor_machine, mixing, robust_rules, sharding, simhash, tag_paths, toxicity, warc
from sluice.llm import edit_counts as counts_of
from sluice.llm.common import held_out, labelled_sample, with_rows
from sluice.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def awkward():
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    base = prose(rng, 40)
    rows = [
        (1, base, "en", "a", 10),
        (2, base, "en", "a", 10),
        (2, base, "en", "a", 10),
        (None, base, None, "b", None),
        (None, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \t\n ", "en", None, 4),
        (7, "one", None, "b", 3),
        (8, prose(rng, 30_000), "de", "b", 1),
        (9, None, "de", "b", 0),
    ]
    return rows + [(20 + k, prose(rng, 60), "en", "ab"[k % 2], 1) for k in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    """The awkward rows with columns named like those the operators use."""
    rows = [(*r, 1.0, "x", 2, 3) for r in awkward()]
    return spark.createDataFrame(rows, DOCS + ", score double, shard string, size int, `odd.name` int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


# -- SimHash ---------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(nodes, near):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {x: root(x) for x in nodes}


def test_fingerprints_by_definition():
    for _, text, *_ in awkward():
        text = (text or "")[:4000]
        assert simhash.fingerprint_of(text.encode()) == plain_fingerprint(text)
    assert simhash.fingerprint_of("A É b".encode()) == plain_fingerprint("A É b")


def test_masks_meet_within_radius():
    rng = random.Random(1)
    masks = simhash.block_masks(6, 2)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("shard_rows", [8192, 3])
def test_links_equal_brute_force(spark, shard_rows):
    """Dense clusters and far prints; small shards are cut into many chunks."""
    rng = random.Random(2)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for bit in rng.sample(range(64), rng.randrange(0, 7)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    rows = [(x - (1 << 64) if x >> 63 else x, k) for k, x in enumerate(prints)]
    links = simhash.link_fingerprints(spark.createDataFrame(rows, "print long, node long"), 4, 6, shard_rows)
    got = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = groups_of(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {k: got.get(k, k) for k in want} == want


def test_bk_tree_follows_edges_within_radius():
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 2**12, 300, np.uint64))
    unit = np.zeros(len(prints), np.int64)
    rows = np.arange(len(prints))
    trees = simhash.grow_trees(unit, prints, rows)
    pairs = {(int(a), int(b)) for x in simhash.ask_trees(trees, unit, prints, rows, 2) for a, b in zip(*x)}
    want = {(a, b) for a in rows for b in rows if a != b and (int(prints[a]) ^ int(prints[b])).bit_count() <= 2}
    assert pairs == want


def test_simhash_groups_on_awkward_rows(docs, none):
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == docs.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add(r["component"])
    assert by_id[1] == by_id[2] == {1}  # copies, a repeated row among them
    assert by_id[5] == by_id[6] == by_id[9] == {5}  # no word: fingerprint zero
    assert by_id[None] == {1, 5}  # without an id: the group of the fingerprint
    assert simhash.simhash_groups(none).count() == 0
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect())[1] == 1
    assert {1, 5, 7, 8} <= {r["doc_id"] for r in kept.collect()} and not {2, 6, 9, None} & {r["doc_id"] for r in kept.collect()}
    assert simhash.keep_one_per_group(none).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(7, 7), (None, 3), (3, 2)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 180)}


# -- decontamination -------------------------------------------------------


def plain_alignment(a, b):
    best, row = 0, [0] * (len(a) + 1)
    for y in b:
        new = [0]
        for j, x in enumerate(a, 1):
            new.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[j - 1] - 1))
            best = max(best, new[-1])
        row = new
    return best


def test_alignment_equals_the_plain_recurrence():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(5) for _ in range(rng.randrange(0, 30))]
        b = [rng.randrange(5) for _ in range(rng.randrange(0, 20))]
        score, start, end = decontaminate.align(a, b)
        assert score == plain_alignment(a, b)
        assert score == plain_alignment(a[start:end], b)


def test_words_of_a_batch():
    import pyarrow as pa

    texts = ["hello, wörld_1 x", "", "aaaaa", "foo bar\nbaz  foo bar", "é", "x" * 3_000_000 + " end", "tail"]
    array = pa.array([t.encode() for t in texts], pa.binary())
    number, start, end, hashes = decontaminate.batch_words(array)
    got = [(int(k), array[int(k)].as_py()[a:b]) for k, a, b in zip(number, start, end)]
    assert got == [(k, w) for k, t in enumerate(array.to_pylist()) for w in decontaminate._WORD_BYTES.findall(t)]
    assert len(set(hashes.tolist())) == len({w for _, w in got})


def test_leaks_found_and_clean_texts_left_alone(spark):
    rng = random.Random(6)
    items = {k: [rng.choice(VOCABULARY) for _ in range(30)] for k in range(8)}
    items[8] = ["kal", "bem"]
    rows, want = [], set()
    for d in range(60):
        words = [rng.choice(VOCABULARY) + "x" for _ in range(200)]
        if d < 24:
            item = list(items[d % 8])
            if d >= 8:  # edited copies: replaced, added and missing words
                for k in rng.sample(range(30), 3):
                    item[k] = "other"
                del item[rng.randrange(30)]
                item.insert(rng.randrange(29), "added")
            words[50:50] = [w.upper() + "," for w in item]
            want.add((d, d % 8))
        if d == 30:
            words[10:10] = ["kal", "bem"]
            want.add((30, 8))
        if d == 31:  # a third of an item is no leak
            words[10:10] = items[0][:9]
        rows.append((d, " ".join(words)))
    rows += [(100, None), (101, ""), (None, " ".join(items[2])), (0, rows[0][1])]
    want.add((None, 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(9, None), (10, ""), (3, " ".join(items[3]))], "item_id long, text string")
    found = decontaminate.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want)
    exact = next(r for r in found if (r["doc_id"], r["item_id"]) == (0, 0))
    assert (exact["score"], exact["first_word"], exact["end_word"]) == (1.0, 50, 80)
    kept = decontaminate.drop_leaks(docs, bench)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontaminate.find_leaks(docs, bench.filter("false")).count() == 0
    assert decontaminate.find_leaks(docs.filter("false"), bench).count() == 0


def test_a_passage_in_most_documents_is_still_found(spark):
    rng = random.Random(7)
    item = [rng.choice(VOCABULARY) for _ in range(25)]
    rows = [(d, " ".join([prose(rng, 20), *item, prose(rng, 20)])) for d in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert decontaminate.find_leaks(docs, bench).count() == 80


def test_edited_copies_equal_alignment_of_everything(spark):
    """A word replaced, added or removed every 3 to 6 words, beside verbatim copies and common phrases."""
    rng = random.Random(15)
    common = VOCABULARY[:12]
    word = lambda: rng.choice(common if rng.random() < 0.4 else VOCABULARY)
    items = {k: [word() for _ in range(size)] for k, size in enumerate((30, 30, 24, 12, 8, 7, 6, 5, 3, 45))}
    rows = []
    for d in range(240):
        item = list(items[d % len(items)])
        every, kind = 3 + d // 60, rng.choice(["replace", "add", "remove", "any"])
        for k in reversed(range(every - 1, len(item), every)) if d % 8 else ():
            how = rng.choice(["replace", "add", "remove"]) if kind == "any" else kind
            item[k : k + (how != "add")] = [] if how == "remove" else [word()]
        rows.append((d, " ".join([*(word() for _ in range(40)), *item, *(word() for _ in range(40))])))
    # The item of the review: every sixth word replaced, a verbatim copy elsewhere.
    items[20] = [f"w{k}" for k in range(30)]
    rows += [(500, " ".join(items[20])), (501, " ".join("x" if k % 6 == 4 else w for k, w in enumerate(items[20])))]
    want = {}
    for d, text in rows:
        for k, item in items.items():
            score = plain_alignment(text.split(), item)
            if score >= max(len(item), 2 * min(5, len(item))):
                want[d, k] = score / (2 * len(item))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found == pytest.approx(want) and want[501, 20] == 0.75


def test_a_shared_form_of_question_is_no_leak(spark):
    """Only rare words join items: 300 items and 300 documents that share a form of question make no pairs."""
    form = "what is the capital of"
    items = [(k, f"{form} land{k} town{k}") for k in range(300)]
    rng = random.Random(31)
    rows = [(d, " ".join([prose(rng, 30), form, *(f"x{d}y{k}" for k in range(30))]), 0, "z") for d in range(300)]
    rows += [(1_000 + k, f"{prose(rng, 20)} {items[k][1]} {prose(rng, 20)}", 0, "z") for k in (3, 77)]
    rows += [(2_000, f"{prose(rng, 20)} what is this capital of land5 town5 {prose(rng, 20)}", 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, words string")
    bench = spark.createDataFrame([(*x, 1, 2) for x in items], "item_id long, text string, place int, gram int")
    found = decontaminate.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1_003, 3), (1_077, 77), (2_000, 5)}
    assert decontaminate.drop_leaks(docs, bench).count() == 300
    # A passage that a few items share is each one's own.
    shared = prose(rng, 30)
    few = spark.createDataFrame([(k, f"{shared} question{k}") for k in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{prose(rng, 9)} {shared} {prose(rng, 9)}")], "doc_id long, text string")
    assert decontaminate.find_leaks(docs, few).count() == 4
    assert decontaminate.find_leaks(docs, few, most_items=1).count() == 0


def test_rare_seeds_have_few_items(spark):
    items = spark.createDataFrame([(k, f"what is the capital of land{k} town{k}") for k in range(50)], "item long, text string")
    grams = decontaminate.item_grams(items.withColumn("version", F.xxhash64("text")), "text", 3, 0.5).withColumn("rows", F.lit(0))
    seeds = decontaminate._seeds(grams, 10)
    rare = seeds.filter("rare").groupBy("gram").agg(F.countDistinct("item").alias("items"))
    assert rare.agg(F.max("items")).first()[0] == 1 and seeds.filter("not rare").count() > 50
    assert seeds.filter("rare").select("item").distinct().count() == 50


def test_a_long_document_with_many_passages(spark):
    import time

    rng = random.Random(8)
    items = [prose(rng, 12) for _ in range(20)]
    filler = [prose(rng, 300) for _ in range(50)]
    text = " ".join(f"{items[k % 20]} {filler[k % 50]}" for k in range(3_000))
    docs = spark.createDataFrame([(1, text), (2, filler[0])], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    began = time.time()
    found = decontaminate.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in found} >= {(1, k, 1.0) for k in range(20)}
    assert time.time() - began < 60


# -- tag paths -------------------------------------------------------------

NOISE = [
    "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two, three.</a></li></ul></nav>",
    "<div class='cookie-notice'>We use cookies, as all do. Accept, or leave.</div>",
    "<aside><p>Related, and more. Read on, reader, for it is good.</p></aside>",
    "<div class='ad'>Buy now, pay later. It is the best, they say.</div>",
    "<form><label>Name</label><input name='x'><button>Send</button></form>",
    "<script>var t = '</p>, text.';</script><style>p{margin:0}</style><!-- a comment, hidden. -->",
]


def test_main_text_without_the_rest():
    rng = random.Random(8)
    for k in range(60):
        body = [f"{prose(rng, rng.randrange(5, 80))}, {prose(rng, 8)}. {prose(rng, 4)}!" for _ in range(rng.randrange(1, 9))]
        inner = "".join(f"<p>{x.replace(' ', rng.choice([' ', '  ', chr(10)]), 3)}</p>" for x in body)
        frame = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div>{}</div>"])
        noise = rng.sample(NOISE, rng.randrange(1, len(NOISE)))
        tail = "<section class='comments'><p>I liked it, but not much. Others, too.</p></section><footer>&copy; 2024, all rights.</footer>"
        html = f"<!DOCTYPE html><html><head><title>T, t.</title></head><body>{''.join(noise)}{frame.format(inner)}{tail}"
        assert tag_paths.main_text(html) == "\n".join(body), (k, html)


def test_main_text_of_awkward_pages():
    assert tag_paths.main_text(None) == tag_paths.main_text("") == tag_paths.main_text("<html><body></body></html>") == ""
    page = "<article><h1>Title</h1><p><b>Bold &amp; <i>open<br><p>One&nbsp;two,\n three.<ul><li>item<li>other, item</ul></article>"
    assert tag_paths.main_text(page) == "Title\nBold & open\nOne two, three.\nitem\nother, item"
    assert tag_paths.main_text("<div class='with-sidebar'><article><p>Text, in a frame.</p></article></div>") == "Text, in a frame."
    assert tag_paths.main_text("<p>a < b, and c > d.</p><p" + "x" * 50_000) .startswith("a < b")
    assert len(tag_paths.main_text("<article>" + "<p>Long, text.</p>" * 50_000 + "</article>").split("\n")) == 50_000


def test_comment_words_and_forms_around_the_text():
    text = "First, a sentence of some length. Then another one, as long as that."
    more = "Here, too, some words follow. They end at last, after a while."
    inner, comments = f"<p>{text}</p><p>{more}</p>", "<section class='comments'><div class='comment'><p>I liked it, but not much.</p></div></section>"
    for page in (
        f"<body class='single comments-open'>{inner}",
        f"<article class='post has-comments'>{inner}</article>",
        f"<article class='review'>{inner}</article>",
        f"<main id='discussion'>{inner}</main>",
        f"<div class='post has-comments'>{inner}</div>",
        f"<form id='aspnetForm'><div>{inner}</div></form>",
        f"<form><nav><p>Menu, more.</p></nav><article>{inner}</article></form>",
        f"<article><p>{text}</p><section id='discussion'><p>{more}</p></section></article>",
        f"<section id='discussion'>{inner}</section>",
        f"<div class='intro'><p>{text}</p></div><div class='content'><p>{more}</p></div>",
    ):
        for tail in ("", comments, f"<form class='search'><p>Find it, here.</p></form>{comments}"):
            assert tag_paths.main_text(f"<html>{page}{tail}") == f"{text}\n{more}", (page, tail)
    # Comments longer than the article they follow.
    long = comments.replace("much.", f"much. {text} {more} {text}")
    assert tag_paths.main_text(f"<article>{inner}</article>{long}") == f"{text}\n{more}"
    reviews = f"<div class='review'><p>{text}</p></div>" * 2
    assert tag_paths.main_text(f"<div class='content'>{inner}</div>{reviews}") == f"{text}\n{more}"


# -- WARC ------------------------------------------------------------------


def test_archive_round_trip(spark):
    big, other = "é" * 600, "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nx" * 40
    rows = [(1, "http://a/x", big), (2, "http://b/", big), (3, "http://c\r\nX: y", big), (4, None, "small"), (5, "u", "small")]
    rows += [(6, "http://d/1", None), (None, "http://e", ""), (8, "http://f/q?x=1", other), (9, "http://f/2", other), (9, "http://f/2", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for compression in ("gzip", "none"):
        found = warc.read(spark, warc.write(pages, compression=compression))
        captures = warc.assemble(found).withColumn("id", warc.page_number()).collect()
        assert len(captures) == len(rows)
        assert all(c["request"] and c["response"] and c["metadata"] for c in captures)
        kinds = Counter((c["id"], c["response"]["type"]) for c in captures)
        assert kinds == Counter(
            {(1, "revisit"): 1, (2, "revisit"): 1, (3, "response"): 1, (4, "response"): 1, (5, "response"): 1, (6, "response"): 1,
             (None, "response"): 1, (8, "revisit"): 1, (9, "response"): 1, (9, "revisit"): 1}
        )
        payloads = {c["id"]: bytes(c["response"]["payload"]).decode() for c in captures if c["response"]["type"] == "response"}
        assert payloads == {3: big, 4: "small", 5: "small", 6: "", None: "", 9: other}
        originals = {c["capture"]: c["id"] for c in captures}
        assert {c["id"]: originals[c["response"]["refers_to"]] for c in captures if c["response"]["type"] == "revisit"} == {1: 3, 2: 3, 8: 9, 9: 9}
    assert warc.assemble(warc.read(spark, warc.write(pages.filter("false")))).count() == 0
    # A record whose partners are missing is a capture with null parts.
    lonely = warc.assemble(found.filter("type = 'request'")).collect()
    assert len(lonely) == len(rows) and all(c["response"] is None and c["request"] is not None for c in lonely)


# -- sharding --------------------------------------------------------------


def test_shards_fit_and_only_full_ones_split(docs, none, spark):
    limit = 3000
    placed = sharding.shard(docs, limit).collect()
    assert len(placed) == docs.count()
    size, members = Counter(), Counter()
    for r in placed:
        assert r["bytes"] == len((r["text"] or "").encode())
        size[r["shard"]] += r["bytes"]
        members[r["shard"]] += 1
    for r in placed:
        assert (r["shard_bytes"], r["shard_docs"]) == (size[r["shard"]], members[r["shard"]])
        assert r["shard_bytes"] <= limit or r["shard_docs"] == 1
        if "#" not in r["shard"]:
            assert len(r["shard"]) == r["depth"]
    # The parent of a shard would not fit.
    for name in size:
        if name and "#" not in name:
            assert sum(n for s, n in size.items() if s.startswith(name[:-1])) > limit
    assert set(placed[0].asDict()) == set(docs.columns) | {"bytes", "shard", "depth", "shard_bytes", "shard_docs"}
    assert sharding.shard(none, limit).count() == 0
    same = spark.createDataFrame([(1, "x" * 100)] * 50 + [(2, "y" * 900)], "doc_id long, text string")
    pages = Counter(r["shard"] for r in sharding.shard(same, 1000).collect())
    assert sorted(pages.values()) == [1, 10, 10, 10, 10, 10]


# -- mixing ----------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if 3 * sizes[s] < weight[s] * level}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_by_repeated_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}": rng.choice([0, 1, 5, 100, 1000, 5000]) for k in range(rng.randrange(1, 12))} | {None: 70}
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = plain_targets(sizes)
    assert {r["source"]: pytest.approx(r["target"]) for r in rows} == want
    assert sum(r["target"] for r in rows) == pytest.approx(sum(sizes.values()))


def test_copies_come_near_targets(spark, docs, none):
    rng = random.Random(9)
    rows = [(k, prose(rng, rng.randrange(1, 40)), rng.choice("aaaab") if k % 9 else None) for k in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(with_rows(table)).collect()
    taken, target, size = Counter(), {}, Counter()
    for r in plan:
        assert 0 <= r["copies"] <= 3 and r["size"] == len(rows[r["doc_id"]][1].split())
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        size[r["source"]] += r["size"]
    assert target == {s: pytest.approx(t) for s, t in plain_targets(dict(size)).items()}
    assert all(abs(taken[s] - target[s]) <= 40 for s in target)
    # Another layout of the same rows gives the same plan.
    again = mixing.plan_mix(with_rows(table.repartition(5, "text"))).collect()
    assert {r["doc_id"]: r["copies"] for r in again} == {r["doc_id"]: r["copies"] for r in plan}
    mixed = mixing.mix(table)
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({r["doc_id"]: r["copies"] for r in plan if r["copies"]})
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() > 0
    assert mixing.mix(none).count() == 0


# -- classifiers -----------------------------------------------------------


def test_sum_of_squares_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    width = 9
    model = factor_machine.FactorMachine(0.3, rng.normal(size=width), rng.normal(size=(width, 4)), np.zeros(0), np.ones(0))
    x = rng.normal(size=(5, width))
    pairs = [
        0.3 + r @ model.weights + sum(model.factors[i] @ model.factors[j] * r[i] * r[j] for i in range(width) for j in range(i))
        for r in x
    ]
    assert np.allclose(model.margin(x), pairs)


def labelled(spark, bad):
    rng = random.Random(10)
    rows, labels = [], []
    for k in range(700):
        good = rng.random() < 0.7
        text = prose(rng, rng.randrange(20, 120))
        rows.append((k, text if good else bad(rng, text)))
        labels.append((k, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def test_quality_on_held_out_rows(spark):
    texts, labels = labelled(spark, lambda rng, t: " ".join(w + rng.choice(["&&&", "$$$", ""]) for w in t.split()))
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = factor_machine.train(texts, known, "quality")
    scored = texts.withColumn("s", factor_machine.quality_score(model)).withColumn("h", held_out())
    right = scored.join(known, "doc_id").filter("h").select(F.avg(((F.col("s") >= 0.5).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97
    kept = factor_machine.keep_good(texts, known)
    assert kept.columns == texts.columns
    again = factor_machine.train(texts.repartition(7), known, "quality")
    assert np.array_equal(model.weights, again.weights) and np.array_equal(model.factors, again.factors)


def test_a_sample_has_one_row_of_each_id(spark):
    rows = [(k, f"text {k}") for k in range(30)] + [(0, f"text {k % 7}") for k in range(500)] + [(3, None)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    samples = [labelled_sample(spark.createDataFrame(x, "doc_id long, text string"), labels, "quality", 12) for x in (rows, rows[::-1])]
    first, second = ({tuple(r) for r in x.collect()} for x in samples)
    assert samples[0].count() == 12 and first == second


def test_quality_on_awkward_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (7, None), (None, 0)], "doc_id long, quality int")
    for known in (labels, labels.filter("false")):
        model = factor_machine.train(docs, known, "quality")
        scores = [r[0] for r in docs.select(factor_machine.quality_score(model)).collect()]
        assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    assert factor_machine.keep_good(docs, labels).columns == docs.columns
    assert factor_machine.keep_good(none, labels).count() == 0


def test_composition_runs_the_transducers_in_turn():
    chain = toxicity.grammar()

    def kinds(text, insults=("idiot",)):
        lexicon = toxicity.Lexicon.of(dict.fromkeys(insults, 3.0))
        tokens = toxicity.words_of(text)
        symbols = [lexicon.symbols.get(t, "|" if not t[0].isalpha() else "w") for t in tokens]
        return [k for k in chain.run(symbols) if k]

    assert kinds("what an idiot") == ["insult"]
    assert kinds("you are an idiot") == ["aimed insult"]
    assert kinds("you are not an idiot") == ["negated"]
    assert kinds("not so. idiot") == ["insult"]  # negation ends with the clause
    assert kinds("he said you idiot") == ["reported"]
    assert kinds("i will kill") == []  # a threat needs a target
    assert kinds("you: kill") == [] and kinds("they will kill") == ["aimed threat"]
    assert kinds("") == []


def test_composition_equals_the_chain_step_by_step():
    rng = random.Random(18)
    chain, (back, *forth) = toxicity.grammar(), toxicity.transducers()
    for _ in range(2_000):
        symbols = [rng.choice(toxicity.SYMBOLS) for _ in range(rng.randrange(30))]
        tape = back.run(symbols[::-1])[::-1]
        for transducer in forth:
            tape = transducer.run(tape)
        assert chain.run(symbols) == tape


def test_inflected_and_idiomatic_sentences():
    wanted = {
        "You people are idiots": ["aimed insult"],
        "she killed you": ["aimed threat"],
        "they were stabbing him": ["aimed threat"],
        "shoot us an email when you can": [],
        "he beat them 3-0 in the final": [],
        "I will beat you": ["aimed threat"],
        "we'll shoot them": ["aimed threat"],
        "I want you to beat them": [],
        "I will not, ever, in any case, hurt you": ["negated"],
        "you are not smart, you idiot": ["aimed insult"],
        "I do not think that you people are idiots": ["negated"],
        "not nice but morons": ["insult"],
    }
    for text, kinds in wanted.items():
        assert clause_kinds(text) == kinds, text


def test_forms_of_words():
    assert toxicity.forms("stab", "s ed ing") >= {"stab", "stabs", "stabbed", "stabbing"}
    assert toxicity.forms("strangle", "s ed ing") == {"strangle", "strangles", "strangled", "strangling"}
    assert toxicity.forms("matar", "o as", "ar") == {"matar", "mato", "matas"}
    lexicon = toxicity.Lexicon.of({"idiot": 5.0, "idiots": 1.5})
    assert lexicon.weights["idioten"] == 5.0 and lexicon.weights["idiots"] == 1.5
    assert {lexicon.symbols[w] for w in "you not said i but".split()} == {"T", "N", "R", "S", "B"}


def clause_kinds(text, lexicon=None):
    """Clause types with any weight in a text."""
    x = toxicity.clause_features(text, lexicon or toxicity.Lexicon.of({}), toxicity.grammar())
    return [kind for kind, weight in zip(toxicity.TYPES, x) if weight]


def test_targets_ahead_reports_and_contractions():
    for text in ("I will kill you", "we will hurt them", "kill\tyou all", "they will kill"):
        assert clause_kinds(text) == ["aimed threat"], text
    for text in ("I will kill", "kill. you", "you: kill", "kill; you", "kill a b c d e f you"):
        assert clause_kinds(text) == [], text
    assert clause_kinds("idiot, all of you") == clause_kinds('"you" idiot') == ["aimed insult"]
    for text in ("he said: you idiot", "he said: you are an idiot", 'he said: "Stop. You are an idiot."', "she wrote “idiot. I will kill you”"):
        assert clause_kinds(text) == ["reported"], text
    assert clause_kinds("he said: no. idiot") == clause_kinds('he said "go.\nidiot') == ["insult"]
    for text in ("you aren't an idiot", "you aren’t an idiot", "I don't kill you", "I won't kill you"):
        assert clause_kinds(text) == ["negated"], text
    assert clause_kinds("you're an idiot") == ["aimed insult"]


def test_learned_words_leave_the_grammar_alone(spark):
    """'you', 'never' and 'called' mark toxic texts; they stay target, negation and report."""
    rng = random.Random(16)
    rows = [(f"{prose(rng, 20)} you never called zorg {prose(rng, 9)}", 1) for _ in range(60)] + [(prose(rng, 32), 0) for _ in range(90)]
    learned = toxicity.learn_lexicon(spark.createDataFrame([(t.encode(), y) for t, y in rows], "text binary, label int"))
    assert {"you", "never", "called", "call*", "zorg"} <= set(learned)
    lexicon = toxicity.Lexicon.of(learned)
    assert "zorg" in lexicon.weights and not {"you", "never", "called", "call*", "calle*", "neve*"} & set(lexicon.weights)
    assert clause_kinds("you called", lexicon) == clause_kinds("never calls", lexicon) == []
    assert clause_kinds("you zorg", lexicon) == ["aimed insult"]
    assert clause_kinds("never zorg", lexicon) == ["negated"] and clause_kinds("he called zorg", lexicon) == ["reported"]


def test_a_common_beginning_merges_no_texts(spark):
    header = "This text is published under a licence that is longer than sixty characters. "
    rows = [(header + str(k), k % 2) for k in range(20)] + [(header + "3", 1), (header + "4", 1)]
    merged = toxicity.merge_copies(spark.createDataFrame([(t.encode(), y) for t, y in rows], "text binary, label int")).collect()
    assert {(bytes(r["text"]).decode(), r["label"]) for r in merged} == {(header + str(k), k % 2) for k in range(20)} and len(merged) == 20


def test_toxicity_on_held_out_rows(spark):
    def worse(rng, text):
        words = text.split()
        for _ in range(3):
            words.insert(rng.randrange(len(words)), "zorg" + rng.choice(["", "il", "on", "ette"]))
        return " ".join(words)

    texts, labels = labelled(spark, worse)
    known = spark.createDataFrame([(k, 1 - y) for k, y in labels], "doc_id long, toxic int")
    model = toxicity.train(texts, known)
    scored = texts.withColumn("s", toxicity.toxicity_score(model)).join(known, "doc_id").filter(held_out()).collect()
    assert all((r["s"] >= 0.7) == (r["toxic"] == 1) for r in scored)


def test_toxicity_on_awkward_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (7, None), (None, 0)], "doc_id long, toxic int")
    assert none.select(toxicity.toxicity_score(toxicity.train(none, labels))).count() == 0
    for known in (labels, labels.filter("false")):
        model = toxicity.train(docs, known)
        scores = [r[0] for r in docs.select(toxicity.toxicity_score(model)).collect()]
        assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    empty, rude = (toxicity.clause_features(t, model.lexicon, toxicity.grammar()) @ model.regression for t in ("", "you are an idiot"))
    assert rude > empty


# -- token counts ----------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    with open(counts_of.TOKENIZER, "rb") as f:
        return counts_of.Counter(f.read())


def test_edits_keep_exact_counts(counter):
    rng = random.Random(11)
    letters = list("ab 'stl \n\n  .!é1  ") + ["'ll", "  ", "\n\n\n", "they're", "\U0001f600"]
    full = lambda t: len(counter.encoding.encode_ordinary(t))
    for _ in range(400):
        tree = counts_of.TokenTree.build("".join(rng.choice(letters) for _ in range(rng.randrange(0, 900))), counter)
        assert tree.total == full(tree.text)
        for _ in range(rng.randrange(1, 8)):
            a = rng.randrange(0, len(tree.text) + 1)
            b = min(len(tree.text), a + rng.choice([0, 0, 1, 2, 5, 40, 300]))
            new = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 5, 200])))
            want = tree.text[:a] + new + tree.text[b:]
            tree.edit(a, b, new)
            assert tree.text == want and tree.total == full(want)
            assert sum(tree.leaves()[0]) == len(want) and sum(tree.leaves()[1]) == tree.total


def test_an_edit_encodes_its_neighbourhood_only(counter):
    text = prose(random.Random(12), 30_000)
    tree = counts_of.TokenTree.build(text, counter)
    tree.encoded = 0
    tree.edit(60_000, 60_010, "changed here")
    assert 0 < tree.encoded < 3000


def test_edits_cost_what_they_touch(counter):
    """Many edits in one document, spread, at one place, and after most of it has been deleted."""
    rng = random.Random(17)
    text = prose(rng, 100_000)
    tree = counts_of.TokenTree.build(text, counter)
    began = time.perf_counter()
    for _ in range(10_000):
        at = rng.randrange(tree.chars[1])
        tree.edit(at, at + 3, "new word")
    for k in range(2_000):
        tree.edit(1000, 1000, f" more {k}")
    tree.edit(5_000, tree.chars[1] - 5_000, "")
    for _ in range(2_000):
        tree.edit(4_990, 5_010, "x y")
    assert time.perf_counter() - began < 5
    assert tree.total == len(counter.encoding.encode_ordinary(tree.text))


def test_a_tree_that_does_not_fit_is_built_anew(spark, counter):
    counts = counts_of.EditCounts(spark)
    rows = spark.createDataFrame([("one two", None), ("one two", ([3], [1]))], f"text string, tree {counts_of.TREE}")
    edits = F.array(F.struct(F.lit(0).alias("start"), F.lit(3).alias("end"), F.lit("three").alias("text")))
    after = [r["after"] for r in rows.withColumn("after", counts.edit("text", "tree", edits)).collect()]
    assert [(a["text"], a["n_tokens"]) for a in after] == [("three two", len(counter.encoding.encode_ordinary("three two")))] * 2


def test_edit_columns_on_awkward_rows(spark, docs, none, counter):
    counts = counts_of.EditCounts(spark)
    mail = spark.createDataFrame([(1, "write to a.b@c.example.org or 10.0.0.1, now"), (2, None)], "doc_id long, text string")
    for table in (mail, docs, none):
        rows = table.select("text", counts.build("text").alias("tree"), counts_of.redactions("text").alias("edits"))
        for r in rows.withColumn("after", counts.edit("text", "tree", "edits")).collect():
            text = r["text"] or ""
            assert sum(r["tree"]["tokens"]) == len(counter.encoding.encode_ordinary(text))
            for e in r["edits"]:
                text = text[: e["start"]] + e["text"] + text[e["end"] :]
            assert r["after"]["text"] == text and r["after"]["n_tokens"] == len(counter.encoding.encode_ordinary(text))
    odd = spark.createDataFrame([("abc def", [None, (5, 2, None), (-4, 99, "x"), (None, 1, "y")]), (None, None)], f"text string, edits {counts_of.EDITS}")
    rows = odd.withColumn("after", counts.edit("text", counts.build("text"), "edits")).collect()
    assert [r["after"]["text"] for r in rows] == ["x", ""]


# -- robust rules ----------------------------------------------------------


def plain_statistics(text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_statistics_by_definition(spark):
    rng = random.Random(13)
    texts = [t for _, t, *_ in awkward()]
    for _ in range(60):
        line = prose(rng, 9)
        texts.append("\n".join(rng.choice([line, prose(rng, 5), "", " \t", "# $ |", line + " x", "é é"]) for _ in range(rng.randrange(1, 12))))
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select("k", *robust_rules.statistics())
    for r in frame.collect():
        assert tuple(r)[1:] == plain_statistics(texts[r["k"]]), texts[r["k"]][:200]


def test_outliers_are_rejected_and_clean_rows_kept(spark):
    rng = random.Random(14)
    rows = []
    for k in range(900):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None, "rare" if k % 30 == 0 else "a"])
        text = prose(rng, rng.randrange(25, 300))
        junk = k % 5 == 0
        rows.append((k, " ".join(w + "$$" for w in text.split()) if junk else text, lang, source, junk))
    judged = robust_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean"))
    verdict = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert all(verdict[k] != junk for k, _, _, _, junk in rows)


def test_mcd_ignores_a_distant_third(spark):
    rng = np.random.default_rng(2)
    clean = rng.normal([5, 1.6, 1, 1, 0.5], [1, 0.2, 0.8, 1, 0.3], (4000, 5))
    far = rng.normal([9, 3, 4, 5, 3], 0.05, (1900, 5))
    rows = [("k", *map(float, x)) for x in np.concatenate([clean, far])]
    estimate = robust_rules.mcd(spark.createDataFrame(rows, "key string, x0 double, x1 double, x2 double, x3 double, x4 double")).first()
    assert all(abs(estimate[f"m{i}"] - m) < 0.2 for i, m in enumerate([5, 1.6, 1, 1, 0.5]))


def test_mcd_against_all_halves(spark):
    from itertools import combinations

    rng = np.random.default_rng(7)
    halves = np.array(list(combinations(range(14), 7)))
    groups, rows = {}, []
    for k in range(24):
        mix = rng.normal(0, 1, (5, 5)) * 0.6 + np.eye(5)
        points = rng.normal(0, 1, (14, 5)) @ mix
        points[: rng.integers(0, 6)] += rng.normal(0, 12, 5)
        groups[f"k{k}"] = points
        rows += [(f"k{k}", *map(float, x)) for x in points]
    frame = spark.createDataFrame(rows, "key string, x0 double, x1 double, x2 double, x3 double, x4 double")
    found = {r["key"]: r for r in robust_rules.mcd(frame).collect()}
    assert found.keys() == groups.keys()
    least = np.diag([robust_rules.SPREAD[name] ** 2 for name in robust_rules.NAMES])
    for key, points in groups.items():
        chosen = points[halves]
        centred = chosen - chosen.mean(axis=1, keepdims=True)
        covs = np.einsum("hni,hnj->hij", centred, centred) / 7 * robust_rules.CONSISTENCY + least
        log_dets = np.linalg.slogdet(covs)[1]
        own = [log_dets[k] for k in np.flatnonzero(np.isclose(log_dets, found[key]["log_det"], atol=1e-6))]
        assert own, "the estimate is that of a half"
        # No step from that half leads to a lower one.
        place = int(np.argmin(np.abs(log_dets - found[key]["log_det"])))
        inverse = np.linalg.inv(covs[place])
        away = points - chosen[place].mean(axis=0)
        near = set(np.argsort(np.einsum("ni,ij,nj->n", away, inverse, away))[:7])
        assert log_dets[[set(h) == near for h in halves.tolist()].index(True)] > found[key]["log_det"] - 2 * robust_rules.FALL
        # Seven points in five dimensions fit nearly exactly in many ways: the estimate is one of the lowest, seldom the lowest.
        assert (log_dets < found[key]["log_det"] - 1e-6).mean() < 0.05


def test_rules_on_awkward_rows(docs, none):
    rows = robust_rules.judge(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 20)
    assert all(r["kept"] for r in rows if r["doc_id"] is not None and r["doc_id"] >= 20)
    assert robust_rules.judge(none).count() == 0


def test_rules_run_no_python(spark, docs):
    plan = robust_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
