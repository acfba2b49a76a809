"""Surrogates: nothing personal is left, equal things stay equal, different ones different."""

from __future__ import annotations

import re

from freshet.llm import surrogates

SCHEMA = "doc_id long, text string"


def run(spark, rows, schema=SCHEMA, key="k"):
    return {(r["doc_id"], n): r for n, r in enumerate(sorted(surrogates.replaced(spark.createDataFrame(rows, schema), key=key).collect(),
                                                             key=lambda r: (str(r["doc_id"]), str(r["text"]))))}


def texts(spark, *values, key="k"):
    rows = surrogates.replaced(spark.createDataFrame(list(enumerate(values)), SCHEMA), key=key).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_types_formats_and_coreference(spark):
    mail, phones, cards, names, ip = texts(
        spark, "to ann.lee.42@mail5.example.com or ANN.LEE.42@MAIL5.EXAMPLE.COM!!", "+1 (743) 555-3824, 743-555-3824 and (743) 555-3825",
        "4111 1111 1111 1111 4111111111111111 5500005555555559", "Mrs. Ada Moss met Mr. Carl Moss, Ms. Moss and Elizabeth Moss", "at 25.86.162.211.")
    lower, upper = re.findall(r"[\w.]+@[\w.]+", mail)
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", lower) and upper == lower.upper() and "ann.lee" not in lower
    one, two, three = re.fullmatch(r"\+1 \((\d{3}\) \d{3}-\d{4}), (\d{3}-\d{3}-\d{4}) and \((\d{3}\) \d{3}-\d{4})", phones).groups()
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(one) == digits(two) != digits(three) and digits(one) != "7435553824"
    a, b, c = re.fullmatch(r"(4\d{3} \d{4} \d{4} \d{4}) (4\d{15}) (5\d{15})", cards).groups()
    luhn = lambda s: sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(s))) % 10
    assert a.replace(" ", "") == b and luhn(b) == luhn(c) == 0 and b != "4111111111111111"
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr\. (\w+) (\w+), Ms\. (\w+) and (\w+) (\w+)", names)
    assert m[2] == m[4] == m[5] == m[7] != "Moss"
    assert m[1] in surrogates.GIVEN["f"] and m[3] in surrogates.GIVEN["m"] and m[6] in surrogates.GIVEN["f"]
    assert re.fullmatch(r"at (\d{1,3}\.){3}\d{1,3}\.", ip) and "25.86.162.211" not in ip


def test_script_is_kept(spark):
    got, = texts(spark, "госпожа Анна Иванова")
    assert re.fullmatch(r"госпожа [А-Я][а-я]+ [А-Я][а-я]+", got) and "Иванова" not in got


def test_clean_text_is_left_alone(spark):
    clean = ["", "No data here, only 12 words and 3.14.", "v1.2.3.4.5 of 2024-01-31", "a@b", "Mr went home", "x" * 20000, " \n\t", "#123-45"]
    assert texts(spark, *clean) == clean


def test_distinct_things_stay_distinct_and_new(spark):
    mails = [f"{a}{b}@q.io" for a in "abcdefghij" for b in "abcdefghij"]  # 100 of the 676 addresses of this form
    out = texts(spark, *mails)
    assert len(set(out)) == len(mails) and not set(out) & set(mails)
    assert texts(spark, *mails) == out  # keyed and repeatable
    assert texts(spark, *mails, key="other") != out


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    schema = "doc_id long, text string, m string, place int"
    rows = [(1, None, "x", 1), (None, "ssn 123-45-6789", "y", 2), (1, "ssn 123-45-6789", "z", None), (1, "ssn 123-45-6789", "z", None)]
    df = surrogates.replaced(spark.createDataFrame(rows, schema), key="k")
    got = df.collect()
    assert len(got) == 4 and df.columns == ["doc_id", "text", "m", "place", "n_mentions__"]
    new = {r["text"] for r in got if r["text"]}
    assert len(new) == 1 and re.fullmatch(r"ssn \d{3}-\d\d-\d{4}", new.pop()) and {r["m"] for r in got} == {"x", "y", "z"}
    assert surrogates.replaced(spark.createDataFrame([], schema)).collect() == []


def test_whole_table_loses_every_planted_entity(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in surrogates.query(spark, sf).collect():
        old = docs[r["doc_id"]]
        found = [m for p in (r"[\w.+-]+@[\w.-]+\w", r"\+\d \(\d{3}\) \d{3}-\d{4}", r"\b\d{16}\b", r"\b\d{1,3}(?:\.\d{1,3}){3}\b") for m in re.findall(p, old)]
        assert not any(m in r["text"] for m in found)
        assert (old == r["text"]) == (not r["n_mentions"]) and len(found) <= r["n_mentions"]


def test_stage_updates_n_chars_and_keeps_columns(spark):
    df = spark.createDataFrame([(1, "Mr. Xu", 6), (2, "plain", 5), (3, None, None)], "doc_id long, text string, n_chars int")
    out = surrogates.replace_stage(spark, df, "")
    assert out.columns == df.columns and all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in out.collect())


def test_names_of_every_form_are_replaced_whole(spark):
    forms = ["Mr. O'Brien left", "Dr. McDonald left", "Ms. Ada Smith-Jones left", "Mr. SMITH left", "Mr. J. R. Tolkien left", "Mrs. D’Arcy’s house",
             "John Smith left", "Mary Moss left", "Maria Garcia left", "Robin Hood left", "JOHN SMITH left", "Mary Ann Moss left", "John F. Kennedy left",
             "Jean-Luc Picard left", "Ольга Петрова ушла"]
    real = ["Brien", "Donald", "Jones", "Smith", "SMITH", "Tolkien", "Arcy", "Moss", "Garcia", "Hood", "Kennedy", "Picard", "Петрова"]
    out = texts(spark, *forms)
    assert not [(t, x) for t in out for x in real if x in t]
    assert all(t.endswith(("left", "house", "ушла")) for t in out)
    assert re.fullmatch(r"Mr\. [A-Z]+ left", out[3]) and re.fullmatch(r"Mrs\. [A-Z][a-z]+’s house", out[5]) and out[3][4:-5] == out[10].split()[1]


def test_bare_surnames_follow_their_document(spark):
    one, two, three = texts(
        spark, "Mrs. Ada Moss came. Moss spoke, MOSS's note and mosses, moss, Mosses. Dr. O'Brien met Ann Smith-Smith; O’Brien, Smith-Smith.",
        "Moss alone grows here at 25.86.162.211", "Mr. Moss and Moss")
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) came\. (\w+) spoke, (\w+)'s note and mosses, moss, Mosses\. Dr\. (\w+) met (\w+) (\w+); (\w+), (\w+)\.", one)
    assert m[2] == m[3] == m[4].capitalize() != "Moss" and m[4].isupper() and m[5] == m[8] != "O'Brien" and m[7] == m[9]
    assert two.startswith("Moss alone") and three == f"Mr. {m[2]} and {m[2]}"
    rows = surrogates.replaced(spark.createDataFrame([(1, "Mr. Moss and Moss")], SCHEMA), key="k").collect()
    assert rows[0]["n_mentions__"] == 2


def test_huge_tokens_neither_overflow_nor_take_long(spark):
    import time
    n = 500_000
    values = ["x a@" + "b." * n + "com y", "x " + "q" * n + "@mail.com y", "Mr. Foo" + "-Bar" * (n // 2) + " left", "Mr. O" + "'a" * (n // 2) + " left",
              "Mrs. Ada Moss " + "." * n + " Moss", "4" * n, "A" * n, "@" * n, "a@" + "b1." * 50 + "com"]
    start = time.time()
    out = texts(spark, *values)
    assert time.time() - start < 240
    assert out[0] == values[0] and out[5:8] == values[5:8]  # a host of half a million labels is none
    assert out[1].startswith("x ") and out[1].endswith(".com y") and len(out[1]) == len(values[1]) and "qqqqqqqqqq" not in out[1]
    assert len(out[2]) < 60 and "Bar" not in out[2] and len(out[3]) < 60 and out[3].endswith(" left")
    assert out[4].endswith(" " + out[4].split()[2]) and "Moss" not in out[4] and out[8] != values[8] and out[8].endswith(".com")


def test_common_names_get_names(spark):
    names = ["James", "Robert", "Michael", "William", "Richard", "Joseph", "Charles", "Christopher", "Daniel", "Matthew", "John", "Thomas", "Paul", "Mark", "George"]
    out = texts(spark, *[f"{n} Smith left" for n in names])
    given = [re.fullmatch(r"(\w+(?:-\w+)?) \w+ left", t)[1] for t in out]
    known = {*surrogates.GIVEN["m"]}
    assert len(set(given)) == len(names) and not set(given) & set(names)
    assert all(set(g.split("-")) <= known for g in given)


def test_email_hosts_match_as_before(spark):
    old = r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
    values = ["a@b.co-x", "c@d..com", "e@f.com9", "g.h@i.j.org", "k@l", "m@-n-.o-p.qq.r", "s@t.u1.vw.x9"]
    df = spark.createDataFrame(list(enumerate(values)), SCHEMA).select("doc_id", surrogates.mentions(surrogates.F.col("text")).alias("m"))
    assert [r["m"] for r in df.orderBy("doc_id").collect()] == [re.findall(old, v) for v in values]


def test_gaps_are_what_a_split_leaves(spark):
    values = ["", "no mention", "25.86.162.211", "a 25.86.162.211 b\0c 1.2.3.4", "\0", "Mr. Moss met a.b@c.io, 25.86.162.211\n", "x\0Mr. Moss", None]
    df = spark.createDataFrame(list(enumerate(values)), SCHEMA).repartition(1)
    text = surrogates.F.col("text")
    got = df.select(surrogates.gaps_of(text).alias("g"), surrogates.F.split(text, surrogates.MENTION, -1).alias("s")).collect()
    assert [r["g"] for r in got] == [r["s"] for r in got] and max(len(r["g"] or ()) for r in got) == 4
    assert texts(spark, "a 25.86.162.211 b\0c 25.86.162.211 d")[0].count("\0") == 1


def test_small_tables_are_dealt_by_their_rows_not_over_every_shuffle_partition(spark, monkeypatch):
    from freshet.llm import common
    made = {}

    def stored(df, what):
        made[what] = max(made.get(what, 0), df.rdd.getNumPartitions())
        return common.stored(df, what)

    monkeypatch.setattr(surrogates, "stored", stored)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame([(n, f"Mr. Moss at 25.86.{n}.211 or a{n}@b.io") for n in range(40)], SCHEMA)
        assert surrogates.replaced(docs, key="k").count() == 40
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {made[k] for k in ("parts", "drawn", "assigned", "collided")} == {1}
