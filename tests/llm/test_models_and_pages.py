"""Trained operators, page extraction, embeddings and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from covaria.llm import extract, language, toxicity, vectors
from covaria.session import cut_lineage

from .helpers import awkward, documents, prose


# --- language


def corpus(n=240):
    rng = random.Random(4)
    parts = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "eit"], "cc": ["ción", "ñe", "que"]}
    rows = []
    for i in range(n):
        lang = sorted(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(4, 60))), lang))
    return rows


def test_language_of_held_out_rows(spark):
    rows = corpus() + [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !!", "cc"), (1003, "kalomi lolo kami", None), (None, "schung schung eitung", None)]
    docs = documents(spark, rows)
    model = language.train(docs.filter(language.fold("doc_id", 4) != 2).select(F.col("doc_id").alias("id"), "text", "lang"))
    got = {r.id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert all(got[i][0] == lang for i, _, lang in rows[:240]) and all(0 <= s <= 1 for _, s in got.values())
    assert all(got[i] == ("und", 0.0) for i in (1000, 1001, 1002))
    assert got[1003][0] == "aa" and got[None][0] == "bb"
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert language.train(docs.limit(0).select(F.col("doc_id").alias("id"), "text", "lang")) is None
    assert language.predict(documents(spark, []), model).count() == 0


def test_ngrams_do_not_depend_on_portions(monkeypatch):
    text = "Übel kalomi Ção 日本語 x1y " * 40
    whole, letter = language.ngram_counts(text)
    monkeypatch.setattr(language, "PORTION", 17)
    parts, _ = language.ngram_counts(text)
    assert letter and (whole == parts).all() and whole.sum() == len(text) * 3 - 3


def test_ftrl_is_sparse_and_temperature_is_a_minimum():
    rng = np.random.default_rng(1)
    rows = [(np.array([y, 10 + int(rng.integers(200))]), np.array([1.0, 0.1]), y) for y in rng.integers(0, 3, 300)]
    w, b = language.ftrl(rows, 3)
    assert (w[:3].argmax(axis=1) == [0, 1, 2]).all() and (w != 0).sum() < 300
    logits, y = rng.standard_normal((400, 3)) * 5, rng.integers(0, 3, 400)
    logits[np.arange(400), y] += 2
    t = language.best_temperature(logits, y)

    def loss(t):
        s = logits / t
        return np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(400), y])

    assert loss(t) <= min(loss(t * 1.1), loss(t / 1.1)) + 1e-9


# --- toxicity


def labelled(n=600):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        words = prose(i, rng.randrange(20, 80)).split()
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["grumpo", "zlotter", "zlottering"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_of_held_out_rows(spark):
    rows, labels = labelled()
    odd = [(2000, None), (2001, ""), (2002, "gr.u.m.p.0 you"), (None, "grumpo zlotter grumpo"), (2003, "zlotter " * 30_000)]
    docs = documents(spark, rows + odd)
    marks = spark.createDataFrame([(i, t, None) for i, t in labels] + [(3000, 1, "x"), (None, 1, None), (5, None, None)], "doc_id long, toxic int, text string")
    model = toxicity.train(toxicity.labelled(docs, marks.select("doc_id", "toxic")))
    assert "grumpo" in model.lexicon and "zlott*" in model.lexicon
    got = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[i] >= 0.7) == bool(t) for i, t in labels]) > 0.98
    assert got[2003] >= 0.7 and got[None] >= 0.7 and got[2000] == got[2001] < 0.7
    kept = toxicity.keep_civil(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.7}


def test_toxicity_without_labels_gives_the_base_rate(spark):
    docs = documents(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled(docs, none))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    ones = toxicity.train(toxicity.labelled(docs, spark.createDataFrame([(0, 1), (2, 1), (3, 1)], "doc_id long, toxic int")))
    assert {r.score for r in toxicity.score(docs, ones).collect()} == {1.0}
    assert toxicity.keep_civil(documents(spark, []), model).count() == 0


def test_features_see_disguise_and_address():
    find = toxicity.finder({"idiot": 5.0, "moro*": 4.0})
    get = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, find)))
    plain = get("you idiot and moronic")
    assert plain["lexicon_density"] == 500.0 and plain["near_second_person"] > 0 and plain["lexicon_weight"] == 5.0
    assert get("1d.i0t i.d.1.o.t")["disguised_hits"] > 0 and get("idiotic humor")["lexicon_hits"] == 0
    assert get("STOP IT NOW!!!")["loud_words"] == 100.0 and get("sooooo")["stretched"] > 0
    assert set(get(None).values()) == set(get("").values()) == {0.0}


# --- pages


@pytest.mark.parametrize("html, want", [
    (None, []), ("", []), ("just text", ["just text"]),
    ("<p>a<p>b", ["a", "b"]), ("<p>a&amp;b &copy; &#x41;&notit;</p>", ["a&b © A¬it;"]),
    ("<div class='ad'>buy</div><article><h1> T\n t </h1><p><b>x<br>y</article><footer>f</footer>", ["T t", "x", "y"]),
    ("<article><p>one</p><div id=comments><p>troll</p></div><p>two</p><aside>s</aside></article>", ["one", "two"]),
    ("<head><title>t</title><style>p{}</style></head><body><script>var a='</p>';if(a<b)x()</script><p>ok</p>", ["ok"]),
    ("<main><header>Title</header>text<!-- <p>no</p> --></main>", ["Title", "text"]),
    ("<nav><ul><li><a href='x'>m</a></ul></nav><p>ok", ["ok"]), ("<p hidden>no</p><p role=navigation>no</p><p>yes", ["yes"]),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", ["a", "b", "c", "d"]), ("</div></p>x<", ["x<"]), ("a<b>c</b>d <i>e", ["acd e"]),
    ("<form><p>f</p></form><p>g", ["g"]), ("<p>cut <a href=\"", ["cut"]), ("<div class='adventure notes'>kept</div>", ["kept"]),
])
def test_blocks(html, want):
    assert [t for _, t in extract.blocks(html)] == want


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(300):
        a = [rng.choice("abcdef") for _ in range(rng.randrange(12))]
        b = [rng.choice("abcdef") for _ in range(rng.randrange(12))]
        shared = [x for x, s in zip(a, extract.shared_lines(a, b)) if s]
        rest = iter(b)
        assert all(x in rest for x in shared) and len(shared) == lcs(a, b)


def test_main_text_differences_pages_without_article(spark):
    frame = "<div>Welcome to the site</div><p>{}</p><div>Contact us here</div>"
    rows = [(i, f"https://h.example/{i:03d}", frame.format(f"story {i}")) for i in range(40)]
    rows += [(100, "https://one.example/", frame.format("alone")), (101, None, frame.format("no url")), (102, "https://h.example/005x", None), (103, "not a url", "<p>q")]
    rows += [(104, "http://k.example/a", "<article><p>same end</p></article>"), (105, "http://k.example/b?x=1", "<article><p>own</p><p>same end</p></article>")]
    rows += [(None, "https://h.example/007", frame.format("null id")), (39, "https://h.example/039", frame.format("story 39"))]
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], "page_id long, url string, html string, id string, lines string")
    got = [(r.id, r.text) for r in extract.main_text(pages).collect()]
    want = [(i, f"story {i}") for i in range(40)]
    want += [(39, "story 39"), (100, "Welcome to the site\nalone\nContact us here"), (101, "Welcome to the site\nno url\nContact us here"), (102, ""), (103, "q")]
    want += [(104, "same end"), (105, "own\nsame end"), (None, "Welcome to the site\nnull id\nContact us here")]
    # The page after the empty one has nothing to be compared with.
    got = [x if x[0] not in (6,) else (6, x[1].split("\n")[-2] if "\n" in x[1] else x[1]) for x in got]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert extract.main_text(pages.limit(0)).count() == 0


def test_every_page_finds_its_neighbour_across_ranges(spark):
    rows = [(i, f"https://h{i % 2}.example/{i:04d}") for i in range(400)]
    near = {r.id: r.partner for r in extract.nearest_by_url(spark.createDataFrame(rows, "id long, url string").repartition(9)).collect()}
    assert near == {i: i - 2 if i > 1 else i + 2 for i in range(400)}


# --- embeddings


@pytest.mark.parametrize("dim, tile, cell", [(3, 512, 8192), (16, 512, 8192), (64, 3, 8192), (70, 512, 2), (64, 2, 2)])
def test_vectors_match_brute_force(spark, monkeypatch, dim, tile, cell):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    monkeypatch.setattr(vectors, "CELL_ROWS", cell)
    rng = np.random.default_rng(dim)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            v = rng.standard_normal(dim)
            for _ in range(int(rng.integers(1, 9))):
                noise = rng.standard_normal(dim) * np.linalg.norm(v) / np.sqrt(dim) * rng.choice([0, 0.05, 0.14, 0.2])
                rows.append((n, (v + noise).tolist(), label))
                n += 1
    rows += [(n, None, 0), (n + 1, [0.0] * dim, 0), (n + 2, [1.0] * (dim - 1) + [float("nan")], 0), (n + 3, [1.0] * (dim - 1) + [None], 0),
             (n + 4, [float("inf")] * dim, 0), (n + 5, [], 1), (n + 6, [2 * x for x in rows[0][1]], 0), (n + 7, [1.0, 2.0], 1)]
    table = spark.createDataFrame([(*r, "q") for r in rows], "vec_id long, embedding array<double>, label int, id string")
    got = {r.id: (r.n_links, r.component) for r in vectors.groups(table).collect()}

    def sound(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cos(a, b):
        a, b = np.array(a, float), np.array(b, float)
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    good = [r for r in rows if sound(r[1], r[2])]
    links = [(a[0], b[0]) for a in good for b in good if a[0] > b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and cos(a[1], b[1]) >= 0.98]
    parent = {r[0]: r[0] for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    degree = dict.fromkeys(parent, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert links and got == {i: (degree[i], root(i)) for i in parent}


def test_vectors_with_nulls_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert vectors.groups(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], 1)] + [(10 + i, [0.0, 1.0], 2) for i in range(300)]
    got = {r.id: (r.n_links, r.component) for r in vectors.groups(spark.createDataFrame(rows, kind)).collect()}
    assert got[None] == (0, None) and got[4] == (1, 4) and got[5] == (1, 4) and got[17] == (299, 10)


# --- pipeline


def test_stages_take_awkward_and_empty_documents(spark, sf):
    for rows in (awkward(), []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            out.collect()
            if name != "best_fit_packing":
                assert out.columns == docs.columns and out.count() <= docs.count()


def test_pipeline_drops_what_it_should(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {"raw": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, sf))
        seen[name] = docs
    ids = {k: {r.doc_id for r in v.select("doc_id").collect()} for k, v in seen.items()}
    assert ids["line_dedup"] == ids["toxicity"] and ids["best_fit_packing"] == ids["benchmark_decontamination"]
    assert ids["benchmark_decontamination"] <= ids["simhash_near_dedup"] <= ids["toxicity"] <= ids["raw"]
    assert len(ids["best_fit_packing"]) > 0.5 * len(ids["raw"])
