from pyspark.sql import functions as F

from scorelake.llm import line_dedup
from tests.llm.docs import awkward, prose, table


def cleaned(spark, texts, **more):
    return line_dedup.drop_recurring_lines(table(spark, texts), **more)


def test_recurring_templates_go_and_the_rest_stays(spark):
    texts = []
    for i in range(8):
        lines = [prose(10 * i, 12), f"Page {i} of 17 printed on day {i}", prose(10 * i + 1, 15), "All rights of this site are reserved by us", "", "The.", prose(10 * i + 2, 9)]
        texts.append((i, "\n".join(lines)))
    got = {r.doc_id: r for r in cleaned(spark, texts, dropped="gone").collect()}
    for i, text in texts:
        lines = text.split("\n")
        assert got[i].text.split("\n") == [x for j, x in enumerate(lines) if j not in (1, 3, 5)]
        assert got[i].gone == 3 and got[i].n_chars == len(got[i].text)


def test_lines_that_differ_in_a_few_words_are_one_template(spark):
    fixed = prose(99, 18)
    texts = [(i, "\n".join([prose(10 * i, 12), fixed.rsplit(" ", 1)[0] + f" {prose(500 + i, 1)}", prose(10 * i + 1, 15)])) for i in range(9)]
    texts += [(20 + i, "\n".join([prose(900 + i, 12), fixed, prose(950 + i, 9)])) for i in range(3)]
    assert all(len(r.text.split("\n")) == 2 for r in cleaned(spark, texts).collect())


def test_copies_of_a_document_keep_their_lines(spark):
    text = "\n".join(prose(i, 14) for i in range(5))
    texts = [(i, text) for i in range(30)] + [(50, text.replace("a", "e", 1))]
    assert {r.text for r in cleaned(spark, texts).collect()} == {text, text.replace("a", "e", 1)}
    alone = [(i, prose(1, 12)) for i in range(30)]
    assert {r.text for r in cleaned(spark, alone).collect()} == {prose(1, 12)}


def test_a_line_of_few_contents_goes_however_many_copies_hold_it(spark):
    line = prose(77, 9)
    texts = [(i, "\n".join([prose(100 + i, 12), line, prose(200 + i, 12)])) for i in range(6)]
    texts += [(1000 + i, texts[0][1]) for i in range(60)]
    assert all(len(r.text.split("\n")) == 2 for r in cleaned(spark, texts).collect())


def test_variants_unlike_the_most_frequent_one_found_templates_of_their_own(spark):
    ends = ["main blog"] * 9 + [f"category {prose(300 + i, 1)}" for i in range(6)] + [f"{prose(400 + i, 1)} archive" for i in range(6)]
    texts = [(i, "\n".join([prose(100 + i, 12), f"Posted in the {end}", prose(200 + i, 12)])) for i, end in enumerate(ends)]
    assert all(len(r.text.split("\n")) == 2 for r in cleaned(spark, texts).collect())


def test_short_lines_and_lines_without_blanks_recur(spark):
    recurring = ["Und äbe.", "版权所有未经许可不得转载本网站的任何内容谢谢合作", "Home\tNews\tSport\tContact\tImprint"]
    texts = [(i, "\n".join([prose(100 + i, 12), *recurring, f"{i} rows", "The.", prose(200 + i, 12)])) for i in range(6)]
    texts += [(50 + i, "\n".join([prose(300 + i, 12), "本网站的内容由第三方提供请联系管理员删除谢谢" + "甲乙丙丁戊己"[i], prose(400 + i, 12)])) for i in range(6)]
    got = {r.doc_id: r.text.split("\n") for r in cleaned(spark, texts).collect()}
    assert all(got[i][1:-1] == [f"{i} rows"] for i in range(6)) and all(len(got[50 + i]) == 2 for i in range(6))


def test_awkward_rows(spark):
    docs = table(spark, awkward())
    got = line_dedup.drop_recurring_lines(docs)
    assert got.schema.fieldNames() == docs.schema.fieldNames()
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert line_dedup.drop_recurring_lines(docs.where(F.lit(False))).count() == 0
