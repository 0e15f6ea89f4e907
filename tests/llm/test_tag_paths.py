"""Tag-path extraction: what it must not lose, deep and long pages, and the ratios against a plain version."""

import random
import time
import tracemalloc
from math import log1p

import pytest

from sluice.llm import tag_paths
from sluice.llm.tag_paths import CONTAINER_MASS, HEADINGS, KERNEL, SHARE, _PUNCTUATION

ONE, TWO = "First, one and more.", "Second, two; the end."


@pytest.mark.parametrize(
    "between",
    [
        "<datalist><option value=a><option value=b></datalist>",
        "<select><option>red<option selected>green, blue</select>",
        "<svg/>",
        "<svg viewBox='0 0 1 1'/>",
        "<svg><path d='M0'/><title>shape</title></svg>",
        "<math/>",
        "<object data=x>",
        "<canvas>",
        "<iframe src='x'>",
        "<noscript>",
        "<div class='ad'><button>Buy</button></div>",
    ],
)
def test_text_behind_odd_elements_stays(between):
    assert tag_paths.main_text(f"<article><p>{ONE}</p>{between}<p>{TWO}</p></article>") == f"{ONE}\n{TWO}"


def test_scripts_without_an_end_take_the_rest():
    assert tag_paths.main_text(f"<article><p>{ONE}</p><script>var a = 'x, y.';<p>{TWO}</p>") == ONE


def test_headers_of_the_article_stay():
    page = f"<div class='site-header'>Shop, news.</div><article><div class='entry-header'><h1>Title</h1></div><p>{ONE}</p><p>{TWO}</p></article>"
    assert tag_paths.main_text(page) == f"Title\n{ONE}\n{TWO}"
    assert tag_paths.main_text(f"<article><header><h1>Title</h1></header><p>{ONE}</p></article>") == ONE


def test_deep_pages_cost_what_they_are_long():
    page = "<div>" * 20_000 + f"<p>{ONE}</p>" + "</div>" * 20_000 + "</section>" * 20_000
    began = time.time()
    assert tag_paths.main_text(page) == ONE
    assert time.time() - began < 5
    tracemalloc.start()
    tag_paths.main_text(page)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()
    began = time.time()
    assert tag_paths.main_text("".join(f"<div>some, text {k}." for k in range(20_000))).count("\n") == 19_999
    assert tag_paths.main_text("<svg>" * 20_000 + f"<p>{ONE}</p>") == ONE
    assert time.time() - began < 10


def plain_content(page):
    """The ratios as the module's docstring states them, path by path and prefix by prefix."""
    paths = {}
    for path, weight, text, linked in page:
        paths.setdefault(path, []).append((text, linked))
    weights = {path: weight for path, weight, *_ in reversed(page)}

    def ratio(path):
        size, n = sum(len(t) for t, _ in paths[path]), len(paths[path])
        marks, linked = sum(len(_PUNCTUATION.findall(t)) for t, _ in paths[path]), sum(k for _, k in paths[path])
        return (size / n) * log1p(marks / n) * (1 - linked / size) if weights[path] else 0.0

    own = {p: ratio(p) for p in paths}
    row = [own[path] for path, *_ in page]
    smooth = {p: [] for p in paths}
    for i, (path, *_) in enumerate(page):
        near = [(w, row[i + k - 1]) for k, w in enumerate(KERNEL) if 0 <= i + k - 1 < len(row)]
        smooth[path].append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    fused = {p: (sum(s) / len(s) * own[p]) ** 0.5 * weights[p] for p, s in smooth.items()}
    best = max(fused.values(), default=0)
    sizes = {p: (sum(len(t) for t, _ in b), sum(k for _, k in b)) for p, b in paths.items()}
    if best <= 0:
        fused = {p: (n - k) * weights[p] for p, (n, k) in sizes.items()}
        best = max(fused.values(), default=0)
        if best <= 0:
            return set()
    chosen = {p for p, v in fused.items() if v >= SHARE * best}
    mass = {p: fused[p] * sizes[p][0] for p in chosen}
    prefixes = {p[:k] for p in chosen for k in range(1, len(p))}
    large = [x for x in prefixes if sum(v for p, v in mass.items() if p[: len(x)] == x and len(p) > len(x)) >= CONTAINER_MASS * sum(mass.values())]
    container = max(large, key=len, default=())
    whole = bool(container) and container[-1].split(".")[0] in ("html", "body")
    more = {p for p, (n, k) in sizes.items() if p[: len(container)] == container and weights[p] and k < n / 2}
    return chosen | {p for p in more if not whole or p[-1].split(".")[0] in HEADINGS}


def random_page(rng):
    def words(n):
        return " ".join(rng.choice(["alpha", "beta,", "gamma.", "delta", "eps!"]) for _ in range(n))

    def node(depth):
        if depth == 0 or rng.random() < 0.3:
            text = words(rng.randrange(1, 30))
            return f"<a href=x>{text}</a>" if rng.random() < 0.2 else text
        tag = rng.choice(["div", "p", "section", "article", "ul", "li", "h2", "nav", "td", "blockquote"])
        name = rng.choice(["", "", " class='content'", " class='sidebar x'", " id=main", " class='row'", " class='comments'"])
        return f"<{tag}{name}>" + "".join(node(depth - 1) for _ in range(rng.randrange(1, 5))) + (f"</{tag}>" if rng.random() < 0.9 else "")

    return f"<html><body>{''.join(node(5) for _ in range(rng.randrange(1, 5)))}</body></html>"


def test_content_paths_equal_the_plain_ratios():
    rng = random.Random(12)
    some = 0
    for _ in range(300):
        page = tag_paths.blocks(random_page(rng))
        got = {path.names() for path in tag_paths.content_paths(page)}
        assert got == plain_content([(path.names(), weight, text, linked) for path, weight, text, linked in page])
        some += bool(got)
    assert some > 250


def test_frames_of_pages(spark):
    page = f"<article><p>{ONE}</p></article>"
    rows = [(1, page, 1, 2), (1, page, 1, 2), (None, None, None, None), (2, "", 0, 0), (3, "plain, text.", 0, 0), (4, "<p>" * 3_000 + ONE, 0, 0)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text int, path int")
    got = pages.select("page_id", tag_paths.extract("html").alias("found")).collect()
    want = [(1, ONE), (1, ONE), (None, ""), (2, ""), (3, "plain, text."), (4, ONE)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert pages.filter("false").select(tag_paths.extract("html")).collect() == []
