import re

import duckdb

from ledgerlake.llm import quality

SCHEMA = "doc_id long, text string, verdict string"
SPACES = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    seen, hot = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hot |= {j for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    base = len(words) < 10 or 100 * len(hot) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hot), base)


def rows(spark, texts):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    return sorted(quality.report(df).collect())


def test_base_counts(spark):
    texts = [None, "", "  \n\t", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "x " * 300, "a b c d e f a b c d e g h i",
             "ein\x0bzwei\x0cdrei\rvier # * || <b>\nzwei\n\nzwei\n zwei", "É É É É 你好 \x1f", "one two three four five six seven eight nine ten"]
    for r in rows(spark, texts):
        assert tuple(r)[1:7] == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_line_rules(spark):
    prose = "this is a plain sentence with more than ten words in it, really."
    texts = [prose, prose + "\nHome | About | Contact | Login", "a | b | c | d | e | f | g | h | i | j | k | l",
             "EA!! IS!! ON!! THE!! OF!! A!! ED!! RE!! IT!! TO!! BE!!", "of%%% the&&& re*** an$$$ ha### of%%% ed&&& on*** at$$$ to### by%%%",
             prose + "\n" + prose, prose + "\nPlease accept cookies to go on."]
    got = [r["kept"] for r in rows(spark, texts)]
    assert got == [True, True, False, False, False, False, True]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    out = quality.clean(df).orderBy("doc_id")
    assert out.columns == df.columns and {r["text"] for r in out.collect()} == {prose}


def test_empty(spark):
    assert rows(spark, []) == [] and quality.clean(spark.createDataFrame([], SCHEMA)).collect() == []


def test_native_plan(spark):
    plan = quality.report(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan


def test_labels(spark):
    """Clean documents stay; of the labelled junk most goes."""
    d = "/root/testdata/sf0.1"
    got = quality.report(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    n = {(r["quality"], r["toxic"], r["kept"], r["base_failed"]): r["count"] for r in got.groupBy("quality", "toxic", "kept", "base_failed").count().collect()}
    clean = [v for k, v in n.items() if k[0] == 1 and not k[3]]
    lost = sum(v for k, v in n.items() if k[0] == 1 and not k[2] and not k[3])
    junk = sum(v for k, v in n.items() if k[0] == 0)
    assert lost <= 0.005 * sum(clean), n
    assert sum(v for k, v in n.items() if k[0] == 0 and k[2]) <= 0.1 * junk, n


def test_oracle(spark):
    from ledgerlake.llm.queries import ORACLE, QUERIES
    from oracle_compare import compare
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    ok, message = compare(QUERIES["op5_quality"](spark, "/root/testdata/sf0.01"), con, ORACLE["op5_quality"])
    assert ok, message
