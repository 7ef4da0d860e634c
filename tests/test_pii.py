"""Personal data: linear patterns, checked hits, pseudonyms that can be joined."""

import random
import re
import time

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quayside.operators import decrypt_columns, pii_scan
from quayside.operators.columns import pseudonym_key, pseudonymise
from quayside.operators.pii import PATTERNS, luhn, mod_97, octets, pii_validated


def test_linear_forms_find_what_the_patterns_find(spark):
    draw = random.Random(1)
    signs = ["a", "b", "@", "@", ".", ".", "-", "_", "+", " ", "1", "+1 555 123 4567", "10.0.0.1", "a@b.c", "x@y.z.", "é", "\n", "%"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 14))) for _ in range(4000)]
    texts += ["a@b.c_d@e.f", "a@b..c@d.e", "a@b.c@d.e", "a@b-c@d.e", "@b.c", "a@.b", "a@b.", "x@a.b.c@d.e", ""]
    found = {row.pattern: (row.rows, row.hits) for row in pii_scan(spark.createDataFrame([(x,) for x in texts], "t string")).collect()}
    for name, regex in PATTERNS.items():
        hits = [len(re.findall(regex, text)) for text in texts]
        assert found[name] == (sum(x > 0 for x in hits), sum(hits)), name
    one = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, t string")
    counted = one.select("k", F.regexp_count("t", F.lit(PATTERNS["email"])).alias("n"))
    assert {row.k: row.n for row in counted.collect()} == {k: len(re.findall(PATTERNS["email"], x)) for k, x in enumerate(texts)}


@pytest.mark.parametrize("text", ["x" * 1_000_000, "a@" + "b." * 100_000 + "c", "a@b" * 300_000, "1" * 1_000_000, "+" * 1_000_000, "1." * 500_000, "a@" + "b-" * 500_000])
def test_odd_texts_take_little_time(spark, text):
    df = spark.createDataFrame([(text + " q@r.s",)], "t string")
    begin = time.perf_counter()
    found = {row.pattern: row.hits for row in pii_scan(df).collect()}
    assert time.perf_counter() - begin < 4
    assert found["email"] >= 1


def test_other_patterns_and_columns(spark):
    df = spark.createDataFrame([("ab", 1, None), (None, 2, "aab")], "t string, n int, u string")
    assert rows(pii_scan(df, patterns={"a": "a"})) == [("t", "a", 1, 1), ("u", "a", 1, 2)]
    assert pii_scan(df, columns=[]).collect() == []


def test_checks(spark):
    def right(check, *texts):
        df = spark.createDataFrame([(x,) for x in texts], "t string")
        return [row[0] for row in df.select(check(F.col("t"))).collect()]

    # Numbers that are published as examples.
    assert right(luhn, "4111111111111111", "5500000000000004", "378282246310005", "4222222222222") == [True] * 4
    assert right(luhn, "4111111111111112", "1234567890123456", "0000000000000001") == [False] * 3
    assert right(mod_97, "GB82WEST12345698765432", "DE89370400440532013000", "FR1420041010050500013M02606") == [True] * 3
    assert right(mod_97, "GB82WEST12345698765431", "DE88370400440532013000") == [False] * 2
    assert right(octets, "1.2.3.4", "255.255.255.255", "0.0.0.0") == [True] * 3
    assert right(octets, "256.1.1.1", "1.1.1.999") == [False] * 2


def test_only_hits_that_pass_count(spark):
    texts = ["4111111111111111 and 4111111111111112", "10.0.0.256 10.0.0.25", "DE89370400440532013000", None, "nothing"]
    df = spark.createDataFrame([(x, x) for x in texts], "t string, u string")
    assert rows(pii_validated(df, ["t"])) == [("t", "card", 1, 1), ("t", "iban", 1, 1), ("t", "ipv4", 1, 1)]
    scanned = {row.pattern: row.hits for row in pii_scan(df, ["t"]).collect()}
    assert scanned["card"] == 3 and scanned["ipv4"] == 2


def test_pseudonyms_join_and_come_back(spark):
    key = pseudonym_key(b"any secret")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "id long, x string")
    two = spark.createDataFrame([(1, "p"), (3, "q"), (None, "r")], "id long, y string")
    hidden, other = pseudonymise(one, ["id"], key), pseudonymise(two, ["id"], key)
    assert hidden.columns == ["id", "x"] and dict(hidden.dtypes)["id"] == "string"
    values = [row.id for row in hidden.collect()]
    assert values[0] == values[3] != values[1] and values[2] is None
    joined = decrypt_columns(hidden.join(other, "id"), [("id", "bigint")], key)
    assert rows(joined) == rows(one.join(two, "id"))
    # Equal again in another run, and another under another secret.
    assert values == [row.id for row in pseudonymise(one, ["id"], key).collect()]
    assert values[0] != pseudonymise(one, ["id"], pseudonym_key(b"other")).first().id
    assert "any secret" not in hidden._jdf.queryExecution().toString()


def test_pseudonyms_of_odd_values(spark):
    key = pseudonym_key(b"k")
    texts = ["", " ", "é中\0", "x" * 100_000]
    df = spark.createDataFrame([(x,) for x in texts], "secret string")
    assert [row.secret for row in decrypt_columns(pseudonymise(df, ["secret"], key), [("secret", "string")], key).collect()] == texts
    with pytest.raises(Exception, match="AES|key|crypto"):
        decrypt_columns(pseudonymise(df, ["secret"], key), [("secret", "string")], pseudonym_key(b"wrong")).collect()
