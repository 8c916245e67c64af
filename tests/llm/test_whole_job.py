"""Rows, lines and elements that a stage must not leave out or take with others."""

import duckdb
import pytest

import corpus_pipeline
from check_oracle import compare
from covaria.llm import decontaminate, extract, templates

from .helpers import documents, prose


def test_decontamination_takes_only_rows_with_a_window(spark, tmp_path):
    leak = prose(700, 12)
    rows = [(None, "x " + leak), (None, "clean without id"), (None, None), (None, "x " + leak), (1, leak), (1, "again"), (2, "fine"), (3, None)]
    docs = documents(spark, rows)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(None, "clean without id"), (None, None), (1, "again"), (2, "fine"), (3, None)]
    got = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(clean, key=str)
    # By id, rows that share an id go together; rows without one never do.
    got = decontaminate.clean_documents(docs, bench)
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted([c for c in clean if c[0] != 1], key=str)


def test_benchmark_items_without_an_id_are_found(spark, tmp_path):
    one, other = prose(701, 12), prose(702, 12)
    documents(spark, [(1, "a " + one), (2, "b " + other), (3, "c " + one + " " + other), (4, "clean")]).write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame([(None, one), (7, other), (None, other)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = decontaminate.op7(spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    cur = con.execute(decontaminate.OP7_SQL)
    assert compare(got.columns, [tuple(r) for r in got.collect()], [d[0] for d in cur.description], cur.fetchall()) is None
    assert {r.doc_id: (r.n_hit, r.n_items) for r in got.collect()} == {1: (12, 0), 2: (12, 1), 3: (24, 1), 4: (0, 0)}


def test_rows_of_numbers_share_no_template(spark):
    rows = [
        (1, "1 2 3 4 5\n10:00 3-1 2024 17 4.5 6 7 8 9"), (2, "6 7 8 9 10\n11:30 0-2 2025 18 5.5 7 8 9 1"), (3, "1 2 3  4 5\nage 1 2 3 4 5"),
        (4, "age 6 7 8 9 1"), (5, "Posted on 12 May 2019"), (6, "Posted on 3 May 2020"),
    ]
    got = {r.doc_id: r.text for r in templates.drop_templates(documents(spark, rows)).collect()}
    # Exact copies still go, and so do templates with constant words.
    assert got == {**dict(rows), 3: "age 1 2 3 4 5", 6: ""}


def test_pipeline_drops_short_lines_and_lines_without_blanks(spark):
    passage = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。"
    rows = [
        (1, "All rights reserved.\nown\nPage 3"), (2, "two\nAll  rights reserved.\nPage 4"), (3, passage + "\nbefore"), (4, "after\n" + passage),
        (5, "\n \nสวัสดีครับ"), (6, "\n \nสวัสดีครับ"), (7, passage.replace("無", "有")), (8, "once here\nonce here"), (None, "All rights reserved."),
    ]
    got = corpus_pipeline.drop_repeated_lines(spark, documents(spark, rows), "")
    # No field in a short line: pages 3 and 4 stay.
    want = {**dict(rows), 2: "two\nPage 4", 4: "after", 6: "\n ", 7: ""}
    assert {r.doc_id: r.text for r in got.collect()} == want


@pytest.mark.parametrize("html, want", [
    ("<div class='layout has-sidebar'><article><p>a</article></div>", ["a"]),
    ("<div id=page class=nav-open><main><p>a</main></div><div class=ad>b</div>", ["a"]),
    ("<div class='layout sidebar'><div id=menu><h2>t</h2><article><p>a</article></div></div>", ["t", "a"]),
    ("<main><section class=widget><h1>t</h1><article>a</article></section></main>", ["t", "a"]),
    ("<div class=banner><main>a<div class=social>b</div></main></div>", ["a"]),
    ("<article><section id=related-work>a</section><section id=social-history>b</section><section id=naval-war>c</section></article>", ["a", "b", "c"]),
    ("<article><p>x <math><mi>y</mi><mo>=</mo><mn>2</mn><annotation>y=2</annotation></math> z</article>", ["x y=2 z"]),
    # Names still count for what is no article, or beside one.
    ("<article>a<div class='box related'><article>card</article></div></article><div id=comments><article>troll</article></div>", ["a"]),
    ("<div class='x ADS'>b</div><nav><article>n</article></nav><p>a", ["a"]), ("<div class=sidebar>b</div>", []),
])
def test_names_do_not_take_articles(html, want):
    assert [t for _, t in extract.blocks(html)] == want
