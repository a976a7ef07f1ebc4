"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from membervane.llm import chunks, digests, language, linealign, mixing, mtree, pieces, simhash, templates, tokencount
from membervane.llm.queries import PIECE_MODEL, TOKEN_RANKS

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 4_000
ROWS = [
    (1, "The house is by the river and the old mill.\nAnd the second line.", "en", "a", 60),
    (2, None, "en", "a", None),
    (3, "", "de", None, 0),
    (4, " \n\t ", None, "b", 4),
    (5, LONG, "de", "b", len(LONG)),
    (6, LONG + "end", None, "b", len(LONG) + 3),
    (7, "The house is by the river and the old mill.\nAnd the second line.", "en", "a", 60),
    (7, "The house is by the river and the old mill.\nAnd the second line.", "en", "a", 60),
    (None, "Text without an id, but not without words.", None, None, 5),
    (8, "12345 !!! 😀 \x00 ▁", "fr", "", 9),
    (9, "x" * 30_000, "fr", "c", 30_000),
    (10, "\n" * 5000 + "same\n" * 5000, "fr", "c", None),
]
OPERATORS = {
    "tokens": lambda d: tokencount.count_documents(d, TOKEN_RANKS),
    "digests": lambda d: digests.compare_with_next(d),
    "lines": lambda d: linealign.dedup_lines(d),
    "spans": lambda d: chunks.repeated_spans(d),
    "chunks": lambda d: chunks.dedup_chunks(d),
    "simhash": lambda d: simhash.near_duplicates(d),
    "pieces": lambda d: pieces.decode(pieces.encode(d, PIECE_MODEL), PIECE_MODEL),
    "pieces at once": lambda d: pieces.encode_and_decode(d, PIECE_MODEL),
    "mix": lambda d: mixing.mix(d),
    "mix and carry": lambda d: mixing.mix(d, carry=True),
    "language": lambda d: language.identify(d),
}
ROW_FOR_ROW = {"tokens", "lines", "chunks", "simhash", "pieces", "pieces at once", "mix", "mix and carry", "language"}
CLASH = "size copies taken target score held_out lang_pred ids decoded fingerprint lines_removed bytes_removed start words stream block rank at".split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, KINDS).repartition(3)


def without_nul(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(docs, name):
    rows = OPERATORS[name](docs).collect()
    if name in ROW_FOR_ROW:
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    if name == "digests":
        assert sorted(r.doc_id for r in rows) == sorted(r[0] for r in ROWS if r[0] is not None)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    empty = OPERATORS[name](docs.where("false"))
    assert empty.count() == 0 and empty.columns == OPERATORS[name](docs).columns


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(docs, name):
    plain, more = OPERATORS[name](docs), OPERATORS[name](docs.withColumns({c: F.lit("own") for c in CLASH}))
    assert without_nul(more.select(*plain.columns).collect()) == without_nul(plain.collect())


@pytest.mark.parametrize("step", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_odd_rows_and_empty_tables(spark, docs, step):
    _, stage = step
    more = docs.withColumns({c: F.lit("own") for c in CLASH})
    found, with_more, empty = (stage(spark, d, "") for d in (docs, more, docs.where("false")))
    assert without_nul(found.collect()) == without_nul(with_more.select(*found.columns).collect())
    assert empty.count() == 0 and empty.columns == found.columns
    if step != corpus_pipeline.STAGES[-1]:
        assert tuple(found.columns) == corpus_pipeline.COLUMNS


def test_defined_results(spark, docs):
    rows = {r.doc_id: r for r in linealign.dedup_lines(docs).collect()}
    assert rows[7].text == "" and rows[2].text is None and rows[3].text == "" and rows[None].lines_removed == 0
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert rows[2].fingerprint == rows[3].fingerprint == rows[4].fingerprint == 0
    assert rows[2].component_id == rows[3].component_id == rows[4].component_id == 2
    assert rows[7].component_id == 1 and rows[None].component_id is None
    rows = {r.doc_id: r for r in language.identify(docs).collect()}
    assert {rows[k].lang_pred for k in (2, 3, 4)} == {"und"} and rows[8].score == 0 and rows[1].lang_pred == "en"
    rows = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert rows[2]["size"] == rows[2].taken == 0
    rows = {r.doc_id: r for r in OPERATORS["pieces"](docs).collect()}
    assert rows[2].decoded is None and rows[3].decoded == "" and rows[5].decoded == LONG and rows[9].decoded == "x" * 30_000
    rows = {r.doc_id: r for r in tokencount.count_documents(docs, TOKEN_RANKS).collect()}
    assert rows[2].n_tokens == rows[3].n_tokens == 0
    rows = {r.doc_id: r for r in digests.compare_with_next(docs).collect()}
    assert rows[2].fingerprint == rows[3].fingerprint == "0:" and rows[1].fingerprint == rows[7].fingerprint


def test_one_row_is_its_own_next(spark):
    (row,) = digests.compare_with_next(spark.createDataFrame([(4, "abcdefghij" * 20)], "doc_id long, text string")).collect()
    assert row.near_next == 1.0


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 1.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.5, 1.0]), (5, [0.5, 1.0]), (20, [0.1]), (None, [1.0, 1.0]), (40, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("own"))
    found = mtree.top_k(df.select("vec_id", mtree.as_integers(F.col("embedding")).alias("vector"), "score"), 20, 20)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    assert got[0, 1] == (5, 32 * 32 + 64 * 64) and got[0, 2] == (20, 32 * 6) and got[0, 3] == (40, 0) and len(got) == 9
    none = mtree.top_k(df.where("false").select("vec_id", F.array(F.lit(1).cast("long")).alias("vector")))
    assert none.count() == 0 and none.columns == found.columns


def test_odd_pages(spark):
    rows = [
        (1, "http://a.org/1", None),
        (2, None, "plain & simple"),
        (3, "not an address", "<p>one<p>two"),
        (None, "http://a.org/4", ""),
        (5, "http://a.org/5", "<div class='x>never closed <p>a</p>"),
        (6, "http://a.org/6", "<b>" * 3000 + "deep"),
        (6, "http://a.org/6", "<b>" * 3000 + "deep"),
        (7, "http://A.org:80/7", "<article>" + "word " * 100_000 + "</article>"),
        (8, "http://a.org/8", "<article><p>Fish &amp; chips&nbsp;&#233;<b>bo</b>ld<br>next <!-- no --></p></article>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("own")).withColumn("text", F.lit("own"))
    got = [(r.page_id, r.text) for r in templates.extract(df).collect()]
    assert sorted(map(str, (g[0] for g in got))) == sorted(str(r[0]) for r in rows)
    texts = dict(got)
    assert texts[1] == texts[None] == "" and texts[2] == "plain & simple" and texts[3] == "one two" and texts[6] == "deep"
    assert len(texts[7].split()) == 100_000 and texts[8] == "Fish & chips ébold next"
    assert templates.extract(df.where("false")).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h1>T</h1><p>one</p><aside>side</aside><div class='comments'><p>c</p></div><p>two</p><footer>by</footer></article>", "T one two"),
        ("<body><header><h1>Site</h1><nav>n</nav></header><main><h1>T</h1><p>body</p><form><label>q</label></form></main><footer>f</footer>", "T body"),
        ("<main><article><header><h1>T</h1></header><p>body</article><aside>s</aside></main>", "T body"),
        ("<div id=page><div id=top-nav><a>home</a></div><div id=main-content><h2>T</h2><p>some body text</p></div><div id=sidebar><p>side " + "long " * 20 + "</div></div>", "T some body text"),
        ("<article><p class=notice>note</p><p>real &lt;b&gt; &#x41;&nbsp;x<ul><li>a<li>b</ul></article>", "real <b> A x a b"),
        ("<article><p>a<script>if(a<b){}</script>b</p><style>x{}</style></article>", "ab"),
        ("<article><p title='a > b' data-x=\"<p>\">text 1 < 2</p></article>", "text 1 < 2"),
        ("<article><p>a</p><p style='display: none'>b</p><div hidden>c</div><div class=advertisement>buy</div></article>", "a"),
    ],
)
def test_kinds_of_pages(page, text):
    assert templates.joined(templates.main_nodes(templates.parse(page), set())) == text


def test_hot_line_passage_and_copies(spark):
    line = "a line of nine words that many documents hold verbatim"
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(k, f"own text number {k} of {k * 7}\n{line}\nmore {k} text") for k in range(600)] + [(1000 + k, f"{k} before it {passage} after it {k}") for k in range(300)]
    rows += [(5000 + k, "the very same short document in many copies") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r.doc_id: r for r in linealign.dedup_lines(docs).collect()}
    assert all(line not in found[k].text for k in range(1, 600)) and line in found[0].text
    assert found[5000].text and all(found[5000 + k].text == "" for k in range(1, 300))
    spans = {r.doc_id for r in chunks.repeated_spans(docs).collect()}
    assert {1000 + k for k in range(1, 300)} <= spans and not spans & set(range(600))
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert {groups[5000 + k] for k in range(300)} == {5000}
