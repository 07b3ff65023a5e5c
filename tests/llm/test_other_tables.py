"""Pages, conversations, vectors, the registered queries and the pipeline."""

import hashlib

import numpy as np
import pytest
from compare import connect, difference

from motefield.llm import chat, html_text, nearest, queries, quality, secrets

from .conftest import SMALL
from .test_documents import UPPER, brute_components, plain_simhash

TREE = html_text.grow(*html_text.labelled_table())


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("no markup at all but quite a number of words in one single block of text, as it were", None),
    ("<article><h1>A &amp; B</h1><p>One\n two&nbsp;three <b>four</b><br>five<p>Six.</article><footer>&copy; x</footer>", "A & B\nOne two three four five\nSix."),
    ("<body><nav><a href=1>Home</a></nav><article><p>Kept.</p><div class='ad'>Buy this now</div><form><p>Your mail</p></form><script>var t='</p>';</script>"
     "<style>p{}</style><!-- gone --><p>Also kept, short.</p><section class=comments><p>I think so too and say it at length here.</p></section></article>", "Kept.\nAlso kept, short."),
    ("<article><p>cut off he", "cut off he"), ("<article><p>a < b &lt;i&gt; <p>x</p", "a < b <i>\nx"),
    ("<div id=sidebar><p>" + "many words " * 40 + "</p></div><main><p>Short.</p></main>", "Short."),
])
def test_main_text(page, text):
    found = html_text.main_text(page, TREE)
    assert found == (page if text is None else text)


LONG = "many ordinary words stand here in a row and make a sentence of some length " * 4 + "and end."


@pytest.mark.parametrize("page, text", [
    (f"<div class='content has-sidebar'><h1>Title here</h1><p>{LONG}</div>", f"Title here\n{LONG}"),
    (f"<div class='sticky-header'><article><p>Short.</p><p>{LONG}</p></article></div>", f"Short.\n{LONG}"),
    (f"<body><form id=aspnetForm><div><h1>Title here</h1><p>{LONG}</p><p>{LONG}</p></div></form>", f"Title here\n{LONG}\n{LONG}"),
    (f"<p>{LONG}</p><p>{LONG}</p><form><p>{LONG}</p></form>", f"{LONG}\n{LONG}"),
    (f"<article><h2 id='legal-background'>Law</h2><p>{LONG}</p><h2 id=related>More</h2><section id=search><p>Short.</p></section></article>", f"Law\n{LONG}\nMore\nShort."),
    (f"<div class=widget><main><p>Short.</p></main></div><aside><article><p>{LONG}</p></article></aside><div class=comments><article><p>{LONG}</p></article></div>", "Short."),
    ("<article><p class=share>tell your friends<p>Kept.<ul><li class=ad>buy<li>Item.</ul><table><tr><td class=ad>buy<td>Cell.<tr><td>Next.</table></article>", "Kept.\nItem.\nCell.\nNext."),
    (f"<p>{'word ' * 93}<a href=x>with seven words that are a link</a></p><p>{LONG}</p>", f"{'word ' * 93}with seven words that are a link\n{LONG}"),
    (f"<p>{LONG}</p><div class='site-footer'><p>{LONG}</p></div><div class=ad-box><p>{LONG}</p></div>", LONG),
])
def test_wrappers_and_links(page, text):
    assert html_text.main_text(page, TREE) == text


@pytest.mark.parametrize("page, text", [
    (f"<article><h1>A title of the page</h1><p><a href=x>Read the paper in full</a></p><p>{LONG}</p></article>", f"A title of the page\nRead the paper in full\n{LONG}"),
    (f"<article><p>{LONG}</p><p>Figure two.</p><figure><a href=x>Enlarge picture</a></figure><p>{LONG}</p></article>", f"{LONG}\nFigure two.\nEnlarge picture\n{LONG}"),
    (f"<article><p>{LONG}</p><p>See also:</p><ul><li><a href=x>One page</a><li><a href=y>Another one</a></ul></article>", f"{LONG}\nSee also:\nOne page\nAnother one"),
    (f"<h1>Title here</h1><p>{LONG}</p><p>{LONG}</p><a href=x><div>A card that leads to some other page of this site</div></a>", f"Title here\n{LONG}\n{LONG}"),
    (f"<h1>Title here</h1><p>{LONG} <a href=x>left open</p><p>{LONG}</p><p>{LONG}</p>", f"Title here\n{LONG} left open\n{LONG}\n{LONG}"),
    (f"<article><p>So <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> holds.</p><p>{LONG}</p></article>", f"So E=m holds.\n{LONG}"),
])
def test_articles_with_links_and_cards_outside_them(page, text):
    assert html_text.main_text(page, TREE) == text


def test_unclosed_elements_cost_no_more_than_their_number():
    import time

    spent = []
    for n in (4_000, 16_000):
        page, start = "<article>" + "<div class=x><li>word " * n + "</span></em></section>" * n, time.process_time()
        assert html_text.main_text(page, TREE).count("word") == n
        spent.append(time.process_time() - start)
    assert spent[1] < 10 * spent[0] and spent[1] < 10


def test_tree_fits_its_table():
    x, y = html_text.labelled_table()
    assert (html_text.classify(TREE, x) == y).mean() > 0.95


def test_extract_keeps_rows(spark, work):
    pages = spark.createDataFrame([(1, "u", None, "a"), (1, "u", "<article>é</article>", "b"), (None, None, "", "c")], "page_id long, url string, html string, text string")
    rows = html_text.extract(pages).collect()
    assert sorted((r["text"], r["n_chars"]) for r in rows) == [("", 0), ("", 0), ("é", 1)]
    assert html_text.extract(pages.where("false")).collect() == []


TRICKY = ["", " ", "[INST] a [/INST]", "</s>", r"<\/s>", r"<\\/s> [\INST]", "[TURN=", "[/TURN]", "a [/INST", " </s", "x\n\ny", "[SYS] [/SYS]", "<s> <s>", "é" * 3, "$1 \\2", None]


def test_round_trip(spark):
    turns = [(c, t, r, x) for c, r in enumerate(["user", "assistant", "system", "tool]", "", None]) for t, x in enumerate(TRICKY)]
    turns += [(90, 0, "user", "same"), (90, 0, "user", "same"), (90, None, "assistant", "first"), (None, 1, "user", "no conversation")]
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    for row in chat.format_conversations(frame).collect():
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in turns if c == row["conv_id"]))
        assert [(p["role"], p["text"]) for p in row["parsed"]] == [(r, x) for *_, r, x in own]
        shown = [row["formatted"][s["start"]:s["start"] + s["length"]] for s in row["loss_spans"]]
        assert len(shown) == sum(r == "assistant" for *_, r, _ in own)
        assert all(x == s for s, x in zip(shown, [x for *_, r, x in own if r == "assistant"], strict=True) if "[" not in x and "<" not in x)
    assert chat.format_conversations(frame.where("false")).collect() == []


def test_losses_come_from_the_mask(spark):
    """The digest of the losses is that of the spans: it follows them where they point elsewhere."""
    turns = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate([("user", "q"), ("assistant", "a </s> [INST]"), ("assistant", ""), ("assistant", "é \\n")])],
                                  "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(turns)
    row = chat.digests(formatted).first()
    assert row["loss_sha256"] == hashlib.sha256("a </s> [INST]é \\n".encode()).hexdigest() and row["loss_chars"] == 17
    moved = formatted.selectExpr("conv_id", "formatted", "parsed", "array(struct(0L AS start, 6 AS length)) AS loss_spans")
    assert chat.digests(moved).first()["loss_sha256"] == hashlib.sha256(b"[INST]").hexdigest()


def test_a_turn_that_does_not_read_back_is_an_error(spark, monkeypatch):
    turns = spark.createDataFrame([(1, 0, "user", "a [/INST] b")], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(turns).first()["parsed"][0]["text"] == "a [/INST] b"
    monkeypatch.setattr(chat, "escape", lambda text: text)
    with pytest.raises(Exception, match="does not read back"):
        chat.format_conversations(turns).collect()


def test_chat_uses_no_python(spark):
    plan = chat.digests(chat.format_conversations(chat.with_probe(spark.read.parquet(f"{SMALL}/conversations.parquet"))))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def brute_search(rows, top, step):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in good:
        if i % step == 0:
            scored = sorted((-float(np.cumsum(v * q)[-1]), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(scored[:top])]
    return out


def test_search_with_odd_vectors(spark, work):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).round(2).tolist()) for i in range(200)] + [(i, [1.0] * 16) for i in range(200, 300)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [None] + [1.0] * 15), (304, [float("nan")] + [1.0] * 15), (305, [float("inf")] * 16), (None, [1.0] * 16), (320, [2.0, 1.0]), (321, [1.0, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS block")
    exact = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = brute_search(exact, 20, 20)
    for block_rows in (32, 1 << 16):
        found = {}
        for r in nearest.search(frame, block_rows=block_rows).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        hits = sum(len({j for _, j, _ in found.get(q, [])} & {j for _, j, _ in e}) for q, e in expected.items())
        assert hits >= 0.99 * sum(map(len, expected.values()))
        assert found[200] == expected[200] and found[320] == expected[320]
    assert nearest.search(frame.where("false")).collect() == []


def test_recall_and_share_over_many_rows():
    """120,000 vectors without clusters, in blocks: what is scored exactly is a small share, and nearly all neighbours are found."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(120_000, 64)) * rng.uniform(0.5, 2.0, size=(120_000, 1))
    ids, asked, top = np.arange(120_000), np.arange(0, 120_000, 600), 20
    best = [[] for _ in asked]
    scored = 0
    for low in range(0, len(ids), 30_000):
        block = nearest.Block(ids[low:low + 30_000], vectors[low:low + 30_000], top)
        for found, own, scores in zip(best, *block.search(asked, vectors[asked]), strict=True):
            found += zip(-scores, own, strict=True)
        scored += block.scored
    hits = 0
    for q, found in zip(asked, best, strict=True):
        products = vectors @ vectors[q]
        products[q] = -np.inf
        hits += len({i for _, i in sorted(found)[:top]} & set(np.argsort(-products)[:top]))
    assert hits >= 0.95 * top * len(asked) and scored < 0.1 * len(asked) * len(ids)


def test_recall_on_the_table(spark, work):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, found = brute_search(rows, 20, 20), {}
    for r in queries.op8_nearest_neighbours(spark, SMALL).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sum(len({j for _, j, _ in found[q]} & {j for _, j, _ in e}) for q, e in expected.items()) >= 0.95 * sum(map(len, expected.values()))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query(spark, work, name):
    result = queries.QUERIES[name](spark, SMALL)
    if name in queries.ORACLES:
        assert difference(result, connect(SMALL), queries.ORACLES[name]) is None
    else:
        assert result.count() > 0


def test_pipeline_against_brute_force(spark, work):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = {r["doc_id"] for r in quality.classify(docs, labels).collect() if r["predicted"]}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"] in kept}
    last = {t.translate(UPPER): i for i, t in sorted(texts.items())}
    texts = {i: t for i, t in texts.items() if i in last.values()}
    prints = {i: plain_simhash(t) for i, t in texts.items()}
    roots = brute_components(set(prints.values()))
    first = {}
    for i in sorted(texts):
        first.setdefault(roots[prints[i]], i)
    texts = {i: texts[i] for i in first.values()}
    table = secrets.ratio_table()
    masked = {i: secrets.mask_spans(t, secrets.find_spans(t, table)) for i, t in texts.items()}
    staged, d = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = work.settle(stage(spark, d, SMALL), name)
        staged[name] = d
        assert d.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in staged["secret_scans"].collect()} == masked
    assert all(r["n_chars"] == len(r["text"]) for r in staged["secret_scans"].collect() if "[SECRET]" in r["text"])
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == set(masked)


def test_stages_on_odd_rows(spark, odd, empty, work):
    from motefield.llm import stages

    exact = stages.drop_exact_copies(odd, work)
    assert exact.columns == odd.columns
    bodies = [(r["text"] or "").translate(UPPER) for r in exact.collect()]
    assert len(bodies) == len(set(bodies)) == len({(t or "").translate(UPPER) for (t,) in odd.select("text").collect()})
    near = stages.drop_near_copies(odd, stages.Workspace(spark, "near")).collect()
    prints = {plain_simhash(t) for (t,) in odd.select("text").collect()}
    assert len(near) == len(set(brute_components(prints).values()))
    assert stages.mask_secrets(odd).count() == odd.count()
    assert stages.drop_exact_copies(empty, stages.Workspace(spark, "none")).collect() == []
    assert stages.drop_near_copies(empty, stages.Workspace(spark, "none2")).collect() == []


def test_two_texts_repeated_under_one_id(spark, work):
    from motefield.llm import stages

    texts = ["red stones lie under the old bridge", "a Letter came from far away this morning", "nobody counted the birds on that roof"]
    rows = [(i, t, k) for i in (5, None) for t in texts for k in range(2)]
    rows += [(i, t.upper(), 2) for i, t, k in rows if k]
    docs = spark.createDataFrame([(i, f"{i} {t}", k) for i, t, k in rows], "doc_id long, text string, copy int")
    expected = sorted(f"{i} {t}".translate(UPPER) for i in (5, None) for t in texts)
    for n, drop in enumerate((stages.drop_exact_copies, stages.drop_near_copies)):
        kept = drop(docs, stages.Workspace(spark, f"repeated-{n}"))
        assert kept.columns == docs.columns
        assert sorted(r["text"].translate(UPPER) for r in kept.collect()) == expected
