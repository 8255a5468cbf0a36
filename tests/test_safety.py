from pyspark.sql import functions as F

from annospark.functions import safety


def test_credentials_paths_and_fields(spark):
    key = "AKIA" + "Q7" * 8
    rows = spark.createDataFrame([("a", f"id {key}"), ("b", 'token = "your_token_goes_here_1234"'), ("private/c", "clean"), ("privately", "clean"), ("d", None)], "path string, text string")
    assert {(r.key, r.reason) for r in safety.safety_issues(rows, ["private"]).collect()} == {("a", "credential"), ("private/c", "forbidden_path")}
    one = spark.createDataFrame([('{"a": 1, "b": ["x", {"c": "y", "d": null}]}',)], "j string")
    assert one.select(safety.allowed_fields(F.col("j"), ["a"]).alias("x")).first().x == ["b"]
    assert one.select(safety.nested_strings(F.col("j")).alias("x")).first().x == ["a", "b", "x", "c", "y", "d"]


def test_each_credential_form(spark):
    word = "Zq7" * 7
    found = [
        "Authorization: " + "Bearer " + word, "github" + "_pat_" + "aB3_" * 13, "x ASIA" + "Q7" * 8, "gh" + "p_" + "a1" * 18, "-----BEGIN " + "RSA PRIVATE KEY-----",
        "-----BEGIN PGP " + "PRIVATE KEY BLOCK-----", '{"pass' + f'word": "{word}"}}', "a: 1\nclient_sec" + f"ret={word}", "export MY_APP_to" + f"ken = '{word}' # note",
        "creden" + f"tial: {word}", "private_k" + f"ey={word}", "access_key" + f"_id: {word}", "to" + "ken=abcdefgh1234", "pass" + "word: my-example-value-1", '{"a":1,"to' + f'ken":"{word}"',
    ]
    clean = [
        "to" + "ken=abcdefgh123", "pass" + "word: <the one you were given>", "api_k" + "ey=${SOME_VARIABLE}", "api_k" + "ey=$SOME_VARIABLE", "sec" + "ret: xxxxxxxxxxxxxxxx", "sec" + "ret: 0000000000000000",
        "pass" + 'word: "must not be logged"', "the to" + f"ken={word}", "gh" + "p_" + "a1" * 19, "Bearer short", None,
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(found + clean)], "i int, text string")
    got = {r.i: r.c for r in rows.select("i", safety.has_credential(F.col("text")).alias("c")).collect()}
    assert [got[i] for i in range(len(got))] == [True] * len(found) + [False] * len(clean)


def test_differences(spark):
    rows = spark.createDataFrame([("a\nb", "a\nc\n"), ("a", "a"), (None, "a")], "x string, y string")
    out = [r.d for r in rows.select(safety.unified_diff(F.col("x"), F.col("y")).alias("d")).collect()]
    assert out[0].endswith("-b\n\\ No newline at end of file\n+c\n") and out[1:] == ["", None]
