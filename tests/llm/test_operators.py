"""Each operator against a brute-force version or an exact round trip, on small tables with nulls, ties and repeated rows."""

import hashlib
import json
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegrain.llm import ann, bpe, chat, common, fm, html, jaccard, lattice, mix, quality, tokenfile
from tidegrain.llm.common import components
from tidegrain.llm.queries import BYTE_BPE, WORD_BPE, tokenizer

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", sources[i] if sources else f"s{i % 3}", len(t) if t else None) for i, t in enumerate(texts)], DOC)


def clash(docs):
    """The same documents with columns that are named as the operators' own."""
    names = "k at late n sig key text_ name size h row start doc component_id n_tokens _n_words root".split()
    return docs.select("*", *[F.lit(-1).alias(n) for n in names])


def corpus(seed=0, n=120):
    """Texts with exact and near copies, shared passages, repeated words, odd signs, nulls and empty ones."""
    g = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["The", "the", "é", "naïve", "漢字", "a.b", "don't", "<|endoftext|>", "!!"]
    passage = [g.choice(vocab) for _ in range(45)]
    out = []
    for i in range(n):
        w = [g.choice(vocab) for _ in range(g.randrange(1, 90))]
        if out and i % 4 == 0:
            w = (g.choice(out) or "x").split()
            for _ in range(g.randrange(0, 4)):
                w[g.randrange(len(w))] = g.choice(vocab)
        if i % 5 == 0:
            at = g.randrange(len(w) + 1)
            w[at:at] = passage
        if i % 17 == 0:
            w = ["ab", "cd"] * 40
        out.append(g.choice([" ", "\n", "  ", " \t"]).join(w))
    return [*out, None, "", "   ", "one", "x " * 3000, "y" * 5000, out[3], out[3]]


# --- op1


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer(BYTE_BPE))
    g = random.Random(1)
    odd = ["".join(g.choice(" \n\t'sdtre09é漢ñ!$<|endoftext|>　 \U0001f600ab") for _ in range(g.randrange(50))) for _ in range(400)]
    texts = corpus() + odd + ["a" * 3000, " " * 60, "<|endoftext|>x", "x <|endoftext|> y", "  a\n\n b"]
    got = {r["doc_id"]: r for r in bpe.digest(clash(frame(spark, texts)), tokenizer(BYTE_BPE)).collect()}
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()), t
    coded = bpe.encode(frame(spark, texts[:40]), tokenizer(BYTE_BPE))
    assert {r["doc_id"]: r["text"] for r in bpe.decode(coded, tokenizer(BYTE_BPE)).collect()} == {i: t or "" for i, t in enumerate(texts[:40])}
    assert bpe.digest(frame(spark, []), tokenizer(BYTE_BPE)).count() == 0


# --- op2, op6


def vectors(spark, seed=0, n=300, d=16):
    g = np.random.default_rng(seed)
    x = g.standard_normal((n, d)).astype(np.float32)
    for i in range(0, n, 6):
        x[i] = x[(i * 7 + 1) % n] + 0.05 * g.standard_normal(d)
    x[20:40] = x[20]  # ties
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    bad = [(n, None), (n + 50, []), (n + 100, [0.0] * d), (n + 150, [None] + [1.0] * (d - 1)), (n + 200, [float("nan")] * d), (n + 250, [float("inf")] + [1.0] * (d - 1)), (None, [1.0] * d)]
    return spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<float>"), x.astype(float), len(rows) + len(bad) + 3


def test_nearest_equals_brute_force(spark):
    df, x, _ = vectors(spark)
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0"), 5, query_block=4, candidate_block=32).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    s = x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None]
    assert sorted(got) == list(range(0, 300, 50))
    for q, rows in got.items():
        want = sorted((-round(s[q, j], 12), j) for j in range(300) if j != q)[:5]
        assert [(a, b) for a, b, _ in sorted(rows)] == [(i + 1, j) for i, (_, j) in enumerate(want)]
        assert max(abs(c + w) for (_, _, c), (w, _) in zip(sorted(rows), want, strict=True)) < 1e-9
    few = df.where("vec_id in (0, 1, 2)")
    assert ann.nearest(few, few.where("vec_id = 0")).count() == 2
    assert ann.nearest(df.where("false"), df.where("false")).count() == 0


def test_ann_mixed_lengths_beside_zero_vectors(spark):
    sound = [(i, [1.0, float(i), 2.0]) for i in range(5)] + [(i, [1.0, float(i)]) for i in range(5, 9)]
    unsound = [(i, [0.0] * 4) for i in range(20, 40)] + [(50, None), (51, []), (52, [1.0, float("nan")]), (53, [1.0, None, 2.0])]
    df = spark.createDataFrame(sound + unsound, "vec_id long, embedding array<double>").coalesce(1)
    ids = [i for b in ann.blocks(df.withColumn("name", F.xxhash64("embedding")), 16, "mixed").collect() for i in np.frombuffer(b["ids"], "<i8").tolist()]
    assert sorted(ids) == list(range(9))
    got = {}
    for r in ann.nearest(df, df, 8).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert got == {i: {j for j in (range(5) if i < 5 else range(5, 9)) if j != i} for i in range(9)}


def test_ann_of_very_large_and_very_small_components(spark):
    rows = [(0, [3.0, 4.0]), (1, [3e200, 4e200]), (2, [4e-200, 3e-200]), (3, [1e308, -1e308]), (4, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in ann.nearest(df, df, 4).collect()}
    exact = {(0, 1): 1.0, (0, 2): 0.96, (0, 3): -0.1 * 2**0.5, (0, 4): 0.6, (2, 4): 0.8, (3, 4): 0.5**0.5}
    assert len(got) == 20 and all(abs(got[a, b] - s) < 1e-12 and abs(got[b, a] - s) < 1e-12 for (a, b), s in exact.items())


def test_lattice_cell_of_most_vectors_is_dealt_before_it_is_cut(spark):
    g = np.random.default_rng(5)
    x = g.standard_normal(16) + 0.01 * g.standard_normal((600, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "rep long, embedding array<double>")
    got = lattice.close_pairs(df, 0.9, lattice.TABLES, lattice.CELLS, lattice.WIDTH, 64).collect()
    assert {(r["a"], r["b"]) for r in got} == {(i, j) for j in range(600) for i in range(j)} and len(got) == 600 * 599 // 2


def test_lattice_links_equal_brute_force(spark):
    df, x, n = vectors(spark)
    got = lattice.near_duplicates(df, 0.9, block=16).collect()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.9) & ~np.eye(300, dtype=bool)
    root = {i: i for i in range(300)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*np.nonzero(near), strict=True):
        p, q = sorted((find(a), find(b)))
        root[q] = p
    assert len(got) == n
    found = sum(r["n_links"] for r in {r["vec_id"]: r for r in got}.values())
    assert found >= 0.9 * near.sum() and all(r["n_links"] <= near[r["vec_id"]].sum() for r in got if r["vec_id"] is not None and r["vec_id"] < 300)
    if found == near.sum():
        assert all(r["component_id"] == find(r["vec_id"]) and r["kept"] == (r["component_id"] == r["vec_id"]) for r in got if r["vec_id"] is not None and r["vec_id"] < 300)
    assert all(r["n_links"] == 0 and r["kept"] and r["component_id"] == r["vec_id"] for r in got if r["vec_id"] is None or r["vec_id"] >= 300)
    assert lattice.near_duplicates(df.where("false")).count() == 0


def test_lattice_points_are_of_e8_and_recall_at_the_limit():
    g = np.random.default_rng(3)
    p = lattice.points(g.standard_normal((200, 8)) * 2, 4)
    assert ((p % 2).sum(2) % 8 == 0).all() and (p.sum(2) % 4 == 0).all()  # all integers or all halves; even sums
    x = g.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = g.standard_normal(x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    a, b = (lattice.keys(v, lattice.TABLES, lattice.CELLS, lattice.WIDTH) for v in (x, y))
    assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b, strict=True)]) >= 0.95


def recall(df):
    """Links that op6 finds on a table of vectors, as a part of all pairs at 0.9 or more, and how many such there are."""
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()]
    found = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(df, 0.9).collect()}
    ids, x = zip(*[(i, v / np.linalg.norm(v)) for i, v in rows], strict=True)
    links = dict(zip(ids, ((np.array(x) @ np.array(x).T >= 0.9).sum(1) - 1).tolist(), strict=True))
    assert all(found[i] <= links[i] for i in links)  # no links that aren't
    return sum(found[i] for i in links) / max(sum(links.values()), 1), sum(links.values())


@pytest.mark.parametrize("cosine", [0.902, 0.92, 0.97])
def test_lattice_recall_of_near_copies_of_given_vectors(spark, cosine):
    """The given tables hold no pair at 0.9, so each vector gets a copy turned by a random direction to a stated cosine."""
    g, given = np.random.default_rng(11), spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").where("embedding is not null").collect()
    rows = [(r["vec_id"], r["embedding"]) for r in given if all(x is not None and np.isfinite(x) for x in r["embedding"]) and any(r["embedding"])]
    copies = []
    for i, v in rows:
        u = np.array(v, float) / np.linalg.norm(v)
        z = g.standard_normal(len(u))
        z -= (z @ u) * u
        copies.append((i + 1_000_000, (cosine * u + np.sqrt(1 - cosine**2) * z / np.linalg.norm(z)).tolist()))
    share, n = recall(spark.createDataFrame(rows + copies, "vec_id long, embedding array<double>"))
    assert n >= 2 * len(rows) and share >= 0.9


@pytest.mark.parametrize("record", ['{"a":' * 100_000, '{"a":' * 5000 + "1" + "}" * 5000, '{"prompt":"\\ud800","response":"x"}', '{"\\udfff":1}', "[", "3", '{"prompt":"a"}'])
def test_odd_records_give_a_problem_and_no_end(spark, record):
    rows = [(1, record), (2, '{"prompt":"a","response":"b"}'), (3, None)]
    got = {r["conv_id"]: r for r in chat.format_json(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    assert got[1]["formatted"] is None and got[1]["problem"] and got[3]["problem"] and got[2]["problem"] is None and got[2]["formatted"]


# --- op3


def test_html():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>"</script><style>p{}</style></head><body>
    <nav><a href="/">Home</a></nav><div class="sidebar"><p>side text</p></div><div class="ad">buy</div>
    <article><h1>Head &amp; tail</h1><p>One <b>bold</b>\n word.<p>Two&nbsp;x<br>three</p><ul><li>a<li>b</ul><form><input value="q">ask</form></article>
    <div id="comments"><p>first!</p></div><footer>&copy; us</footer></body></html>"""
    assert html.main_text(page) == "Head & tail One bold word. Two x three a b"
    plain = "<body><div class=menu><a href=x>a</a> <a href=y>b</a></div><div id=c><p>" + "Long text of the article. " * 20 + "</p><p>" + "More of it here. " * 20 + "</p></div><div><a href=z>next</a></div></body>"
    assert html.main_text(plain).startswith("Long text") and html.main_text(plain).endswith("here.") and "next" not in html.main_text(plain)
    assert [html.main_text(x) for x in (None, "", "<p>", "<script>x", "<!-- x")] == [""] * 5
    assert html.main_text("<body>" + "<div>" * 5000 + "deep") == "deep"
    assert html.main_text("just text") == "just text"


def test_html_density_chooses():
    p = lambda word, n: f"<p>{word} " + "and more of the text, " * n + f"end{word}.</p>"
    several = "<body><nav><a href=/>Home</a></nav><div>" + "".join(f"<article><h2>Title{i}</h2>{p(f'one{i}', 9)}{p(f'two{i}', 9 + i)}{p(f'three{i}', 5)}</article>" for i in range(4)) + "</div><div><a href=x>elsewhere</a> <a href=y>more</a></div></body>"
    got = html.main_text(several)
    assert all(f"{w}{i}" in got for i in range(4) for w in ("Title", "one", "two", "endthree"))
    nested = html.main_text(several.replace("</h2>", "</h2><div>").replace("</article>", "</div></article>"))
    assert nested.split() == got.split()
    mixed = "<body><article>" + p("first", 40) * 8 + "</article><article>" + p("second", 3) + "</article><div><a href=x>elsewhere</a></div></body>"
    assert "endsecond" in html.main_text(mixed) and "elsewhere" not in html.main_text(mixed)
    cards = "".join(f"<article><a href=/{i}>Teaser {i} of another story</a></article>" for i in range(5))
    story = html.main_text("<body><div id=story><h1>Head</h1>" + "".join(p(f"s{i}", 10) for i in range(8)) + f"</div><section>{cards}</section></body>")
    assert story.startswith("Head s0") and story.endswith("ends7.") and "Teaser" not in story
    parts = html.main_text("<body><main><h1>Head</h1><section>" + p("a", 9) * 5 + "</section><section>" + p("b", 9) * 4 + "</section></main><div><a href=x>elsewhere</a></div></body>")
    assert parts.startswith("Head a") and parts.endswith("endb.")


def test_html_layout_classes():
    story = "<h1>Head</h1>" + "".join(f"<p>s{i} " + "and more of the text, " * 9 + f"end{i}.</p>" for i in range(6))
    whole = html.main_text(f"<body>{story}</body>")
    for attrs in ("class='content has-sidebar'", "class='site with-sidebar'", "id='no-header'", "class='job-search results'", "class=hidden", "style='display:none'", "class='page menu'"):
        assert html.main_text(f"<body><div {attrs}><article>{story}</article></div></body>") == whole, attrs
        assert html.main_text(f"<body><div {attrs}>{story}</div><div><a href=x>next</a></div></body>") == whole, attrs
    assert html.main_text(f"<body><article><div class='entry-header'>{story[:13]}</div>{story[13:]}</article></body>") == whole
    for attrs in ("class=sidebar", "class='left sidebar'", "id=comments", "role=navigation", "class='x ads'", "hidden"):
        assert html.main_text(f"<body><article>{story}</article><div {attrs}><p>aside from it</p></div></body>") == whole, attrs
    assert html.main_text("<body><div class=ad>" + "buy more " * 20 + "</div><article><p>Short.</p></article></body>") == "Short."


def _naive_choice(root):
    """The node of the largest density sum, with every count taken anew for every node."""
    import math

    def texts(x):
        return [(k, x.tag) for k in x.kids if isinstance(k, str)] + [t for k in x.kids if not isinstance(k, str) for t in texts(k)]

    def tags(x):
        return [k for k in x.kids if not isinstance(k, str)] + [t for k in x.kids if not isinstance(k, str) for t in tags(k)]

    def size(x):
        return sum(len("".join(t.split())) for t, _ in texts(x))

    def linked(x):
        return size(x) if x.tag == "a" else sum(linked(k) for k in x.kids if not isinstance(k, str))

    def dens(c, t, lc, lt):
        if not c:
            return 0.0
        base = max(math.log(c / max(c - lc, 1) * lc + share * c + math.e), 1.0001)
        arg = (c / lc) * (max(t, 1) / max(lt, 1)) if lc else max(c * max(t, 1), 2)
        return c / max(t, 1) * max(math.log(max(arg, 1.0)) / math.log(base), 0.0)

    def own(x):
        below = tags(x)
        return dens(size(x), len(below), linked(x), sum(k.tag == "a" for k in below))

    body = next(x for x in [root, *tags(root)] if x.tag == "body")
    share = linked(body) / max(size(body), 1)
    sums = {x: sum(dens(len("".join(k.split())), 0, 0, 0) if isinstance(k, str) else own(k) for k in x.kids) for x in [body, *tags(body)] if x is body or html.container(x)}
    return max(sums, key=lambda x: (round(sums[x], 6), x.tag in ("article", "main"))), sums


def test_html_choice_equals_naive_density():
    pages = [r["html"] for r in pq.read_table("/root/testdata/sf0.01/pages.parquet").slice(0, 200).to_pylist()]
    story = "".join(f"<p>word {i} {'more words of it ' * i}</p>" for i in range(6))
    pages += [f"<body><div>{story}</div><div>{'<p>teaser <a href=x>go</a></p>' * 9}</div></body>", f"<body><section><article>{story}</article></section><article><a href=x>{'card ' * 30}</a></article></body>"]
    for page in pages:
        root = html.parse(page)
        html.main_nodes(root)
        best, sums = _naive_choice(root)
        top = max((x for x in sums), key=lambda x: (round(x.total, 6), x.tag in ("article", "main")))
        assert top is best and abs(top.total - sums[best]) <= 1e-6 * max(1, sums[best])


def test_html_threshold_decides_on_blocks_beside():
    long_ = "<p>" + "plenty of words in here, one after another, for a while. " * 4 + "</p>"
    page = "<body><div>{}</div><section>{}</section><section><p>{}</p></section></body>"
    inside = html.main_text(page.format(long_ * 4, long_, "ok"))
    assert inside.count("plenty") == 20 and "ok" not in inside.split()


def test_html_density_drops_furniture_that_no_tag_tells():
    """Menus, adverts and footers of given pages rewritten as plain blocks; the article's text is the one of its element."""
    import itertools
    import re

    pages = [r["html"] for r in pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"]).slice(0, 300).to_pylist()]
    whole = [html.text_of(html.parse(re.search(r"<article.*?>(.*)</article>", page, re.S)[1])) for page in pages]
    swaps = {"menu": (r"<(/?)nav[^>]*>", r"<\1div>"), "footer": (r"<(/?)footer[^>]*>", r"<\1div>"), "advert": (r'<div class="ad">', "<div>")}
    for n, article in itertools.product((1, 2, 3), (True, False)):
        for names in itertools.combinations(swaps, n):
            right = 0
            for page, text in zip(pages, whole, strict=True):
                for name in names:
                    page = re.sub(*swaps[name], page)
                right += html.main_text(page if article else re.sub(r"<(/?)article[^>]*>", r"<\1div>", page)) == text
            assert right >= 0.95 * len(pages), (names, article, right)


def test_html_header_of_an_article_keeps_its_title():
    story = "".join(f"<p>s{i} " + "and more of the text, " * 9 + f"end{i}.</p>" for i in range(6))
    whole = html.main_text(f"<body><article><h1>Head</h1>{story}</article></body>")
    for tag in ("article", "main"):
        page = f"<body><header><h1>Site</h1></header><{tag}><header class=header><div><h1>Head</h1></div><p>By someone</p><nav><h2>Menu</h2></nav></header>{story}</{tag}></body>"
        assert html.main_text(page) == whole, tag


def test_html_odd_markup_takes_linear_time():
    import time

    for odd in ('<a "', "<b c='", "<!", "<textarea>", "<b><li>", "</x>", "<!--", "<a b=", "<"):
        now = time.perf_counter()
        html.main_text(odd * (1_000_000 // len(odd)))
        assert time.perf_counter() - now < 5, odd  # with steps back it is minutes
    assert html.main_text('<body><p title="a > b">one</p><p title="open>two</p><p>three</p></body>') == "one two three"
    assert html.main_text("<body><p it's>one</p><p>two</p></body>") == "one two"


def test_html_ties_and_empty_table(spark):
    same = "<div><p>alike words here</p><p>alike words here</p></div>"
    assert html.main_text(f"<body>{same}{same}</body>") == " ".join(["alike words here"] * 4)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, None, None), (1, "u", "<p>a</p>"), (None, "v", "x" * 100000)], "page_id long, url string, html string")
    got = sorted(((r["page_id"] or 0, r["n_chars"], len(r["text"])) for r in html.extract(df.withColumn("text", F.lit(1))).collect()))
    assert got == [(0, 100000, 100000), (1, 1, 1), (1, 1, 1), (2, 0, 0)]


# --- op4


def brute_components(texts):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("light", [8, 2])
def test_jaccard_equals_brute_force(spark, monkeypatch, light):
    monkeypatch.setattr(jaccard, "scan_lists", lambda p, f=jaccard.scan_lists: f(p, light))
    g = random.Random(5)
    base = [f"v{i}" for i in range(60)]
    near = []
    for _ in range(40):  # a group of near copies around the limit
        w = list(base)
        for _ in range(g.randrange(0, 4)):
            w[g.randrange(60)] = f"z{g.random()}"
        near.append(" ".join(w))
    small = [" ".join(f"q{(i + j) % 9}" for j in range(5 + i % 12)) for i in range(30)]
    texts = corpus(2, 80) + near + small
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(clash(frame(spark, texts))).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)


def test_jaccard_edges(spark):
    assert jaccard.join(frame(spark, [])).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f", "", "", 0), (7, "a b c d e f", "", "", 0), (7, "a b c d e f", "", "", 0), (9, None, "", "", 0)], DOC)
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in jaccard.join(df).collect()) == [(-1, 7), (7, 7), (7, 7), (9, 9)]
    kept = jaccard.deduplicated(df).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(7, "a b c d e f"), (9, None)]
    assert jaccard.choose_boundary({5: 10, 200: 10}) < 200


def shuffled(spark) -> int:
    """Bytes that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_jaccard_deals_only_what_pairs_read(spark, request):
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # tables too large to be sent to all
    g = random.Random(8)
    texts = [" ".join(f"{g.random():.12f}" for _ in range(400)) for _ in range(300)]
    docs = frame(spark, [*texts, texts[7] + " a b"]).cache()
    named = jaccard.named_sets(docs, F.col("doc_id"), 0).where("n > 0").cache()
    of = {r["doc_id"]: r["sig"] for r in named.select("doc_id", "sig").collect()}
    pairs = spark.createDataFrame([(of[7], of[300])], "a long, b long")
    docs.count()
    at = shuffled(spark)
    assert jaccard.compare(pairs, docs, F.col("doc_id"), named.select("sig", F.col("k").alias("rep_k"))).collect() == [(of[7], of[300], 396, 398)]
    assert shuffled(spark) - at < sum(map(len, texts)) / 20
    at = shuffled(spark)
    ((*_, differ, size),) = jaccard.prune(pairs, named.select("sig", "n", "sketch")).collect()
    assert differ <= 2 and size == 396 + 398 and shuffled(spark) - at < 256 * 300 / 10
    docs.unpersist()
    named.unpersist()


def test_jaccard_in_slices(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHARE", 40)
    monkeypatch.setattr(jaccard, "MAYBE", 128)  # nearly full: rows that aren't wanted pass as well
    runs, compare = [], jaccard.compare
    monkeypatch.setattr(jaccard, "compare", lambda pairs, *a: runs.append(pairs.count()) or compare(pairs, *a))
    g, texts = random.Random(9), corpus(6, 60)
    for i in range(8):  # near copies whose sketches have more bits than a fold
        w = [f"u{i % 3}-{j}" for j in range(600)]
        for _ in range(g.randrange(1, 25)):
            w[g.randrange(600)] = f"z{g.random()}"
        texts.append(" ".join(w))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts)
    assert sum(n > 0 for n in runs) > 3


def test_names_that_collide_are_given_anew(spark, monkeypatch):
    texts = corpus(4)
    df = frame(spark, texts)
    want = sorted((r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect())
    tried, alone = [], jaccard.alone
    monkeypatch.setattr(jaccard, "alone", lambda *a: bool(tried.append(1)) or len(tried) > 1 and alone(*a))  # the first seed is refused
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect()) == want and len(tried) == 2
    twice = df.union(df.where("doc_id = 3"))
    assert common.names(df)._jc.toString() == F.col("doc_id").cast("long")._jc.toString()
    k = twice.select(common.names(twice).alias("k"))
    assert k.distinct().count() == df.count() == k.count() - 1


def test_components_of_hubs(spark, monkeypatch):
    monkeypatch.setattr(common, "HUB", 5)
    edges = [(1, i) for i in range(2, 40)] + [(40, i) for i in range(41, 60)] + [(59, 30), (70, 71), (72, 71)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 60)} | {70: 70, 71: 70, 72: 70}


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 200), (300, 200), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(e).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}


# --- op5


def test_mix(spark):
    texts = corpus(3, 200)
    sources = [[None, "a", "b", "ü", "c"][i % 5] if i % 3 else "a" for i in range(len(texts))]
    df = frame(spark, texts, sources)
    rows = mix.taken(clash(df.withColumnRenamed("lang", "target"))).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mix.taken(df).collect()))
    size = [len(WORD.findall(t or "")) for t in texts]
    per = {s: sum(n for n, q in zip(size, sources, strict=True) if q == s) for s in set(sources)}
    names = sorted((s for s in per if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(per.values())
    while True:
        free = [s for s in names if s not in full]
        level = (total - sum(2 * per[s] for s in full)) / sum(weight[s] for s in free) if free else 0
        new = {s for s in free if level * weight[s] >= 2 * per[s]}
        if not new:
            break
        full |= new
    goal = {s: 2 * per[s] if s in full else level * weight[s] for s in names}
    got = {r["doc_id"]: r for r in rows}
    taken = dict.fromkeys(names, 0)
    for i, s in enumerate(sources):
        assert got[i]["size"] == size[i] and got[i]["source_size"] == per[s] and got[i]["target"] == pytest.approx(goal[s]) and 0 <= got[i]["taken"] <= 2 * size[i]
        taken[s] += got[i]["taken"]
    assert all(abs(taken[s] - goal[s]) <= 5 for s in names)
    out = mix.mixed(df).collect()
    assert sum(len(WORD.findall(r["text"])) for r in out) == sum(taken.values()) and out[0].asDict().keys() == set(df.columns)
    assert mix.taken(frame(spark, [])).count() == 0 and mix.taken(frame(spark, ["", None])).count() == 2
    assert "Python" not in mix.taken(df)._jdf.queryExecution().toString() and "Arrow" not in mix.mixed(df)._jdf.queryExecution().toString()


def test_mix_small_sources_beside_a_huge_one(spark):
    size = {"big": [4000] * 50, "mid": [300] * 10, "rare": [7, 5, 9], "one": [1], "tiny": [40, 20]}
    rows = [(n, s) for s, sizes in size.items() for n in sizes]
    df = frame(spark, [" ".join(["w"] * n) for n, _ in rows], [s for _, s in rows])
    plan = {"big": "zz", "mid": "yy"}
    for name in (lambda s: s, lambda s: plan.get(s, s), lambda s: s[::-1]):  # in several orders, so at several places
        named = df.withColumn("source", F.create_map(*[F.lit(x) for s in size for x in (s, name(s))])[F.col("source")])
        got = mix.taken(named, 2**9).collect()  # blocks of 597 words
        per = {}
        for r in got:
            s = rows[r["doc_id"]][1]
            per[s] = per.get(s, 0) + r["taken"]
            assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sum(size[s])
        target = {rows[r["doc_id"]][1]: r["target"] for r in got}
        assert [per[s] for s in ("rare", "one", "tiny", "mid")] == [round(target[s]) for s in ("rare", "one", "tiny", "mid")]
        assert abs(per["big"] - target["big"]) <= 5 * 597
        assert sum(len(WORD.findall(r["text"])) for r in mix.mixed(named, 2**9).collect()) == sum(per.values())
    slots = [r["slot"] for r in mix.pieces(df, 2**9).where("source = 'mid' and slot is not null").select("slot").distinct().collect()]
    assert len(slots) > 200 and min(slots) < 10 and max(slots) > 500


# --- op7


def test_token_file_round_trip(spark):
    from tokenizers import Tokenizer

    lib, texts = Tokenizer.from_file(tokenizer(WORD_BPE)), corpus(4) + ["É İ ΑΣ b́ \x1c!\x1c! c", "x,, y.. z.,", "<|endoftext|> a<|startoftext|>B <|ENDOFTEXT|> <|StartOfText|>x <|", "x" * 100_000, "x" * 100_000]
    got = {r["doc_id"]: r for r in tokenfile.read(tokenfile.write(clash(frame(spark, texts)), tokenizer(WORD_BPE))).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)
    assert tokenfile.read(tokenfile.write(frame(spark, []), tokenizer(WORD_BPE))).count() == 0


def test_token_ids_of_odd_texts():
    from tokenizers import Tokenizer

    lib, enc, rng = Tokenizer.from_file(tokenizer(WORD_BPE)), tokenfile.Encoder(tokenizer(WORD_BPE)), random.Random(3)
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|StartOfText|>", "<|", "|>", "A", "b", "É", "İ", "ß", "'S", "'re", "12", " ", "  ", "\n", "\t", "\u00a0", "!", "中", "\u0301", "😀", "&&&"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(5000)]
    for t, got in zip(texts, enc.encode_all(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_plain_pieces_are_the_models_alone(monkeypatch):
    """Pieces that the vocabulary's rules leave as they are take one call of its model, and those that come again are held."""
    from tokenizers import Tokenizer

    lib, enc, rng = Tokenizer.from_file(tokenizer(WORD_BPE)), tokenfile.Encoder(tokenizer(WORD_BPE)), random.Random(4)
    enc.lib = None
    monkeypatch.setattr(tokenfile.Encoder, "LIMIT", 20)
    bits = ["THE", "été", "größe", "ÿ", "a", "Z", "9", "10", ",", ".", "!?", "(", "[x]", "~", " ", " ", "\n"]
    for _ in range(2000):
        t = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t
        assert len(enc) + len(enc.old) <= 20
    calls, model = [], enc.model
    enc.model = lambda p: calls.append(p) or model(p)
    for i in range(30):
        enc.encode(f"again {chr(97 + i % 26)}{'x' * i}")
    assert calls.count("again") <= 1


def test_new_runs_of_many_texts_take_few_calls(monkeypatch):
    """The model takes all new runs in one call and none alone; what is held keeps to LIMIT, and ids are the library's."""
    from tokenizers import Tokenizer

    lib, enc, rng = Tokenizer.from_file(tokenizer(WORD_BPE)), tokenfile.Encoder(tokenizer(WORD_BPE)), random.Random(5)
    monkeypatch.setattr(tokenfile.Encoder, "LIMIT", 1000)
    calls, model, runs = [], enc.model, enc.runs
    enc.model = lambda p: calls.append(p) or model(p)

    class Runs:
        def encode_batch_fast(self, *args, **named):
            calls.append(args)
            return runs.encode_batch_fast(*args, **named)

    enc.runs = Runs()
    bits = ["THE", "été", "größe", "ÿ", "a", "9", "10", ",", ".", "!?", "<", "x" * 15, "y" * 16, "z" * 17, "w" * 300, "&&&&&&&&&", " ", " ", "\n"]
    texts = ["", " ", "\n", *("".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(3000))]
    for t, got in zip(texts, enc.encode_all(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t
    assert len(calls) <= 1 and len(enc) + len(enc.old) <= 1000


def test_many_odd_texts_with_ends():
    from tokenizers import Tokenizer

    lib, enc, rng = Tokenizer.from_file(tokenizer(WORD_BPE)), tokenfile.Encoder(tokenizer(WORD_BPE)), random.Random(6)
    bits = ["it's", "'", "\0", "\0\0", "\x0b", "\t", "É", "×", "ß", "÷", "ũ", "é", "́", " ", " ", "abc", "7", "--", "<|endoftext|>", "<", "|", " ", " ", "\n", "\r\n", "😀", "中"]
    for some in (0, 1, 2, 3000):
        texts = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(some)]
        flat, lengths = enc.encode_many([t.encode() for t in texts], np.array([1], "<u4").tobytes())
        assert len(lengths) == some and lengths.sum() == len(flat)
        for t, got in zip(texts, np.split(flat, np.cumsum(lengths)[:-1]) if some else [], strict=True):
            assert got.tolist() == [*lib.encode(t, add_special_tokens=False).ids, 1], t


def test_places_are_by_frequency():
    ids = np.array([9, 9, 9, 7, 5, 5, 2**25, 2**25, 2**25, 2**25], "<u4")
    for some in (ids, ids[:6]):
        start, at = tokenfile.Start.of(some)
        assert (np.diff(start.times.astype(int)) <= 0).all() and (start.ids[at] == some).all()
        again = tokenfile.Start.of_arrays(start.arrays())
        assert (again.ids == start.ids).all() and (again.times == start.times).all() and (again.follow == start.follow).all()


def test_coder_beats_order_0():
    enc = tokenfile.Encoder(tokenizer(WORD_BPE))
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()]
    ids = np.frombuffer(b"".join(enc.encode_all(texts)), "<u4")
    p = np.bincount(ids)
    p = p[p > 0] / len(ids)
    assert 8 * len(tokenfile.pack([1], [len(ids)], ids)) / len(ids) < -(p * np.log2(p)).sum()


def test_files_are_smaller_than_order_0():
    """Eight files, heads and all, against the entropy of the ids of all of them, for which no table is counted."""
    enc = tokenfile.Encoder(tokenizer(WORD_BPE))
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").sort_by("doc_id").column("text").to_pylist()]
    own = [np.frombuffer(x, "<u4") for x in enc.encode_all(texts)]
    p = np.bincount(np.concatenate(own))
    p = p[p > 0] / p.sum()
    size = 0
    for i in range(8):
        part = own[i * len(own) // 8 : (i + 1) * len(own) // 8]
        size += len(tokenfile.pack(list(range(len(part))), [len(x) for x in part], np.concatenate(part)))
    assert 8 * size / sum(map(len, own)) < -(p * np.log2(p)).sum()


def test_blocks_and_damage():
    g = np.random.default_rng(0)
    for n in (0, 1, 7, tokenfile.BLOCK - 1, tokenfile.BLOCK, tokenfile.BLOCK + 1, 9000):
        ids = np.where(g.random(n) < 0.5, g.integers(0, 50, n), g.integers(0, 49408, n)).astype("<u4")
        data = tokenfile.pack([3, None], [n, 0], ids)
        docs, lengths, back = tokenfile.unpack(data)
        assert docs == [3, None] and lengths == [n, 0] and (back == ids).all()
    wide = g.integers(0, 2**32, 20000, dtype=np.uint64).astype("<u4")  # as many distinct ids as there are
    assert (tokenfile.unpack(tokenfile.pack([1], [len(wide)], wide))[2] == wide).all()
    same = np.tile(np.arange(100, dtype="<u4"), 100)
    data = tokenfile.pack([1], [len(same)], same)
    assert len(data) < len(same)  # under a byte an id where ids are predictable
    with pytest.raises(ValueError, match="block"):
        tokenfile.unpack(data[:-40] + bytes(40))
    with pytest.raises(ValueError, match="head"):
        tokenfile.unpack(data[:40] + bytes([data[40] ^ 1]) + data[41:])
    many = g.integers(0, 300, (tokenfile.TWICE + 1) * tokenfile.BLOCK).astype("<u4")
    data = tokenfile.pack([-(2**63), 2**63 - 1, None], [5, len(many) - 5, 0], many)
    for at in (0, 7, 15, 60, len(data) - 60, len(data) - 10, len(data) - 1):  # one of the two heads
        docs, lengths, back = tokenfile.unpack(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
        assert docs == [-(2**63), 2**63 - 1, None] and lengths == [5, len(many) - 5, 0] and (back == many).all(), at
    with pytest.raises(ValueError, match="head"):
        tokenfile.unpack(data[:60] + bytes([data[60] ^ 1]) + data[61:-60] + bytes([data[-60] ^ 1]) + data[-59:])


# --- op8


def test_chat(spark):
    g = random.Random(0)
    parts = [*chat.CONTROL, "\\", "-", "<", "a", "|>", "\n"]
    for _ in range(500):
        turns = [(g.choice(["user", "assistant", "a|<b"]), "".join(g.choice(parts) for _ in range(7))) for _ in range(3)]
        text, mask = chat.render(turns)
        assert chat.read_back(text) == turns and text.count(chat.OPEN) == 3
        assert [chat.unescape(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
        assert not any(c in chat.escape(t) for _, t in turns for c in chat.CONTROL)
    want = [("user", "q"), ("assistant", "r")]
    for r in ({"prompt": "q", "response": "r"}, {"question": "q", "answer": "r"}, {"instruction": "q", "input": "", "output": "r"}, {"messages": [{"role": "Human", "content": "q"}, {"role": "gpt", "content": "r"}]}, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}):
        assert chat.canonical(r) == want
    with pytest.raises(ValueError, match="zz"):
        chat.canonical({"zz": 1})
    j = spark.createDataFrame([(1, json.dumps({"prompt": "q", "response": "r"}))], "conv_id long, record string")
    assert chat.digest(chat.format_json(j)).first()["n_turns"] == 2
    rows = spark.createDataFrame([(1, 1, "assistant", None), (1, 0, "user", "é"), (2, 0, "assistant", "</s>"), (2, 0, "assistant", "</s>"), (None, 0, None, "x")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_rows(rows.withColumn("turns", F.lit(1)))).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\né\nassistant\n\n") and got[1]["loss_chars"] == 0
    assert got[2]["loss_sha256"] == sha("</s></s>") and got[2]["n_turns"] == 2 and got[None]["turns_sha256"] == sha("null\nx\n")
    assert chat.digest(chat.format_rows(rows.where("false"))).count() == 0


# --- op9


def test_quality_against_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    r = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), sample=600).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    hit = r.where("kept = (quality = 1)").count() / r.count()
    assert hit >= 0.97
    odd = spark.createDataFrame([(1, None, "", "", 0), (2, "", "", "", 0), (2, "", "", "", 0)], DOC)
    assert [x["kept"] for x in quality.classify(clash(odd)).collect()] == [False] * 3
    assert quality.classify(odd.where("false")).count() == 0 and quality.kept(odd).count() == 0


def test_small_letters_of_any_script_are_not_looked_at_one_by_one(monkeypatch):
    text = "été größe, ça. abc. λόγος привет,"
    plain = {w: quality.Reader.word(w.encode()) for w in text.split()}
    monkeypatch.setattr(quality.Reader, "word", staticmethod(lambda w: pytest.fail(f"{w} looked at")))
    r = quality.Reader()
    stats, shapes = r.read(text)
    assert stats[0] == 6 and stats[7] == 2 / 6 and not stats[1:4].any() and abs(shapes.sum() - 1) < 1e-6
    assert set(r.kinds) == set(plain.values())  # as if each had been


def test_em_equals_a_version_document_by_document():
    import math

    g = random.Random(5)
    docs = [[g.choice((-1, 0, 1)) if g.random() < 0.4 else (1 if g.random() < 0.8 else 0) for _ in range(10)] for _ in range(120)]
    docs += docs[:30]
    counts = {}
    for v in docs:
        counts[quality.pattern(v)] = counts.get(quality.pattern(v), 0) + 1
    got, _ = quality.expectation_maximisation(counts, rounds=25)
    good = [0.1 if -1 in v else 0.95 for v in docs]
    for _ in range(25):
        mass = [sum(1 - p for p in good), sum(good)]
        prior = [(m + 1) / (len(docs) + 2) for m in mass]
        chance = []
        for j in range(10):
            p = [[0.5 + sum(w for w, v in zip(([1 - x for x in good], good)[k], docs, strict=True) if v[j] == x) for x in (-1, 0, 1)] for k in (0, 1)]
            p = [[x / sum(row) for x in row] for row in p]
            for x, low, high in ((0, 1, 0), (2, 0, 1)):
                if p[low][x] > p[high][x]:
                    p[0][x] = p[1][x] = p[0][x] * prior[0] + p[1][x] * prior[1]
            chance.append([[x / sum(row) for x in row] for row in p])
        new = []
        for v in docs:
            bad_, good_ = (math.log(prior[k]) + sum(math.log(chance[j][k][v[j] + 1]) for j in range(10)) for k in (0, 1))
            new.append(1 / (1 + math.exp(max(-50, min(50, bad_ - good_)))))
        if max(abs(a - b) for a, b in zip(good, new, strict=True)) < 1e-9:
            break
        good = new
    for v, p in zip(docs, good, strict=True):
        assert abs(got[quality.pattern(v)] - p) < 1e-6


def test_chat_layouts(spark):
    records = ['{"prompt": "a", "response": "b"}', '{"messages": [{"role": "User", "content": "x"}, {"role": "gpt", "content": null}]}', '{"instruction": "i", "input": "", "output": "o"}', '{"messages": []}', '{"prompt": "a", "response": "b", "more": 1}', "[1]", "x", None]
    df = spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")
    got = {r["conv_id"]: r for r in chat.format_json(df).collect()}
    turns = {i: chat.read_back(r["formatted"]) for i, r in got.items() if r["formatted"] is not None}
    assert turns == {0: [("user", "a"), ("assistant", "b")], 1: [("user", "x"), ("assistant", "")], 2: [("user", "i"), ("assistant", "o")], 3: []}
    assert all(got[i]["problem"] and got[i]["mask"] is None for i in range(4, 8)) and "more" in got[4]["problem"]
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    prints = {chat.fingerprint(chat.paths(json.loads(r["record"]))) for r in chat.rows_as_records(rows).collect()}
    assert len(prints) > 1 and chat.format_rows(rows.where("false")).count() == 0


def test_votes_pack():
    for v in ([0] * 10, [1, -1] * 5, [-1] * 10):
        assert quality.votes_of(quality.pattern(v)) == v


# --- op10


def brute_dedup(texts):
    seen, out = set(), []
    for t in texts:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            if key in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(key)
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("heavy", "probed"), [(256, 32), (3, 32), (3, 1)])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, heavy, probed):
    monkeypatch.setattr(fm, "PROBED", probed)  # with 1, hot anchors are known beforehand
    texts = corpus(6)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in fm.digest(clash(frame(spark, texts)), heavy).collect()}
    assert [got[i] for i in range(len(texts))] == brute_dedup(texts)


def test_substring_dedup_edges(spark):
    t = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(5, t, "", "", 1), (5, t, "", "", 1), (None, t, "", "", 1), (6, None, "", "", None)], DOC)
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in fm.digest(df).collect())
    assert got == [(-1, 25), (5, 0), (5, 0), (6, 0)]
    assert fm.digest(df.where("false")).count() == 0


def test_index_counts():
    g = np.random.default_rng(0)
    seq = np.concatenate([np.append(g.integers(1, 6, 30), 0) for _ in range(40)]).astype(np.int64)
    index = fm.FMIndex(seq)
    text = seq.tolist()
    for _ in range(50):
        at = int(g.integers(0, len(seq) - 4))
        want = text[at : at + 4]
        if 0 in want:
            continue
        lo, hi = np.array([0]), np.array([len(seq)])
        for c in reversed(want):
            lo, hi = index.step(np.array([c]), lo, hi)
        assert hi[0] - lo[0] == sum(text[i : i + 4] == want for i in range(len(text) - 3))


def test_matching_statistics_equal_brute_force():
    g = np.random.default_rng(4)
    parts = [g.integers(1, 4, 40) for _ in range(12)]
    parts += [parts[0][5:38], parts[3]]
    texts = [b" ".join(b"w%d" % x for x in p) for p in parts[:-1]]
    copies = [1] * len(texts)
    copies[3] = 2  # the last part is a copy of the fourth
    place = np.array([(i, 0, i) for i in range(len(texts))], np.int64)
    late, length = fm.shard(texts, place, copies)
    runs = [p.tolist() for p in parts]

    def stands(run):
        return sum(p[i : i + len(run)] == run for p in runs for i in range(len(p) - len(run) + 1))

    want = [max([n for n in range(fm.SEED, 21) if stands(p[e - n : e]) > 1], default=0) for p in runs[:-1] for e in range(20, len(p) + 1)]
    assert length.tolist() == want
    first = {}
    for i, p in enumerate(runs[:-1]):
        for s in range(len(p) - 19):
            first.setdefault(tuple(p[s : s + 20]), (i, s))
    assert [x.tolist() for x in late] == [[s for s in range(len(p) - 19) if first[tuple(p[s : s + 20])] != (i, s)] for i, p in enumerate(runs[:-1])]


def test_index_finds_the_repeated_windows(spark, monkeypatch):
    """Every late window's text reaches the full matching statistic in some shard, copies and heavy anchors included."""
    texts, found = corpus(6), {}
    src = frame(spark, texts)
    docs = fm.docs_of(src, fm.names(src)).select(F.coalesce("doc_id", F.lit(fm.NO_ID)).alias("doc"), "k", "text")
    for heavy in (256, 3):
        rows = fm.segments(docs, fm.repeated(docs.select("k", "text"), heavy)).where("name is not null").collect()
        whole = {}
        for r in rows:
            now = whole.setdefault((r["key"], bytes(r["name"])), [bytes(r["text"]), 0])
            now[1] += r["copies"]
        own = [x for x in whole.values()]
        _, length = fm.shard([x[0] for x in own], np.array([(i, 0, i) for i in range(len(own))], np.int64), [x[1] for x in own])
        at, got = 0, set()
        for text, _ in own:
            w = text.split()
            for s in range(len(w) - 19):
                if length[at] == 20:
                    got.add(tuple(w[s : s + 20]))
                at += 1
        found[heavy] = got
    count = {}
    for t in {(i, t) for i, t in enumerate(texts)}:
        w = (t[1] or "").encode().split()
        for s in range(len(w) - 19):
            count[tuple(w[s : s + 20])] = count.get(tuple(w[s : s + 20]), 0) + 1
    late = {x for x, n in count.items() if n > 1}
    assert late and found[256] == found[3] == late
