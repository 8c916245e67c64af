"""Stages decide by row: repeated ids of different text, equal rows, rows without an id."""

from collections import Counter

import corpus_pipeline
from covaria.llm import decontaminate, simhash, templates

from .helpers import documents, prose

PASSAGE = prose(910, 40)


def kept_rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def order(row):
    return row[0] is None, row[0] or 0, row[1]


def fingerprint(text):
    return simhash.fingerprint(None if text is None else text.encode())


def test_one_row_of_each_group_stays(spark):
    other, third = prose(911, 300), prose(912, 300)
    near = other + " tail"
    rows = [(1, PASSAGE)] * 3 + [(None, other)] * 2 + [(None, near), (5, third), (5, other), (6, third), (7, None), (None, ""), (8, None)]
    rows += [(9, prose(913, 50)), (None, prose(914, 50)), (5, prose(915, 50)), (-4, prose(915, 50))]
    docs = documents(spark, rows)
    got = kept_rows(simhash.keep_one(docs, by_row=True))
    # Plain search: groups of linked texts, one row of each.
    texts = list({t for _, t in rows})
    groups = {t: {t} for t in texts}
    bits = lambda a, b: bin((fingerprint(a) ^ fingerprint(b)) & (2**64 - 1)).count("1")
    for a in texts:
        for b in texts:
            if bits(a, b) <= 4 and groups[a] is not groups[b]:
                both = groups[a] | groups[b]
                for t in both:
                    groups[t] = both
    assert sum(got.values()) == len({id(g) for g in groups.values()}) and set(got) <= set(rows)
    for group in {id(g): g for g in groups.values()}.values():
        stays = [r for r in got if r[1] in group]
        least = min((i is None, i or 0) for i, t in rows if t in group)
        assert len(stays) == 1 and (stays[0][0] is None, stays[0][0] or 0) == least
    assert simhash.keep_one(documents(spark, []), by_row=True).count() == 0
    assert simhash.keep_one(docs, by_row=True).columns == docs.columns


def test_lines_go_from_the_row_that_holds_them(spark):
    clean = "a clean line of its own here\nand another line that is clean"
    rows = [
        (1, PASSAGE), (2, PASSAGE + "\nsecond line of the row two is clean"), (2, clean), (None, PASSAGE + "\nno id but words of its own"),
        (None, "only here and nowhere else at all\n" + clean.replace("clean", "tidy")),
    ]
    want = dict(rows=Counter(rows))["rows"]
    for i, text in (rows[1], rows[3]):
        want[i, text] -= 1
        want[i, text.split("\n")[1]] += 1
    got = kept_rows(templates.drop_templates(documents(spark, rows), by_row=True))
    assert got == +want
    # By id, rows without one lose nothing; the clean row of id 2 keeps its lines either way.
    got = kept_rows(templates.drop_templates(documents(spark, rows)))
    assert got[rows[2]] == got[rows[3]] == 1 and got[2, rows[1][1].split("\n")[1]] == 1


def test_one_of_rows_without_a_smaller_id_keeps_its_lines(spark):
    rows = [(4, PASSAGE + "\nfirst tail of id four stands here"), (4, PASSAGE + "\nsecond tail of id four stands here"), (None, PASSAGE)]
    got = kept_rows(templates.drop_templates(documents(spark, rows), by_row=True, short=True))
    assert sum(n for (_, t), n in got.items() if PASSAGE in t) == 1 and sum(got.values()) == 3
    only = [(None, PASSAGE), (None, PASSAGE + "\nmore words without an id here")]
    got = kept_rows(templates.drop_templates(documents(spark, only), by_row=True, short=True))
    assert sum(n for (_, t), n in got.items() if PASSAGE in t) == 1


def test_spans_go_from_the_row_that_holds_them(spark):
    leak = prose(700, 12)
    rows = [(None, "before " + leak), (None, "clean text that is not any of it"), (None, "x y z"), (3, leak), (3, "the same id and clean words"), (None, None)]
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    got = kept_rows(decontaminate.remove_spans(documents(spark, rows), bench))
    assert got == Counter([(None, "before"), *rows[1:3], (3, ""), *rows[4:]])


def test_pipeline_stage_keeps_one_row(spark):
    rows = [(1, PASSAGE), (1, PASSAGE), (None, PASSAGE), (5, prose(920, 60)), (5, PASSAGE)]
    got = kept_rows(corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), ""))
    assert got == Counter([rows[0], rows[3]])
