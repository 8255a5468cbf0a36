import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annospark.functions import hashing, locate, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first().x


def test_tokens_split_at_all_white_space(spark):
    spaces = [c for c in map(chr, range(0x110000)) if c.isspace() and not 0xD800 <= ord(c) < 0xE000]
    assert len(spaces) == 29
    body = "a" + "a".join(spaces) + "a"
    assert one(spark, text.token_count(F.col("t")), t=body) == len(body.split()) == 30


def test_canonical_is_nfc_with_line_feeds(spark):
    body = "Café\r\nx\ry"
    assert one(spark, text.canonical(F.col("t")), t=body) == "Café\nx\ny"
    assert one(spark, text.canonical(F.col("t")), t=None) is None


def test_strata_bounds(spark):
    rows = spark.createDataFrame([(n,) for n in (199, 200, 400, 401)], "n int")
    assert [r.s for r in rows.select(text.stratum(F.col("n")).alias("s")).collect()] == ["short", "medium", "medium", "long"]


def test_positions_overlap(spark):
    assert one(spark, text.positions(F.col("t"), F.col("n")), t="aaaa", n="aa") == [0, 1, 2]
    assert one(spark, text.positions(F.col("t"), F.col("n")), t="aaaa", n="") == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé̀ \r\n😀ç̧x", max_size=20))
def test_offset_map_agrees_with_normalisation(body):
    value, at = text.canonical_offsets(body)
    whole = unicodedata.normalize("NFC", body.replace("\r\n", "\n").replace("\r", "\n"))
    assert value == (whole[:-1] if whole.endswith("\n") else whole)
    assert len(at) == len(body.encode("utf-16-le")) // 2 + 1
    known = [x for x in at if x is not None]
    assert known == sorted(known) and known[-1] == len(whole)


def test_utf16_spans(spark):
    rows = spark.createDataFrame([("A😀 Café\r\nfinal\r\n", [(4, 9), (4, 8), (0, 99)])], "t string, s array<struct<first:int,past:int>>")
    found = rows.select(text.utf16_spans(F.col("t"), F.col("s")).alias("x")).first().x
    assert tuple(found[0]) == (3, 7, "Café") and found[1] is None and found[2] is None


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab „“«-– \n'’", max_size=30))
def test_plain_typography_keeps_offsets(body):
    plain = locate.plain(body)
    assert len(plain.at) == len(plain.value) + 1
    for i, c in enumerate(plain.value):
        original = body[plain.at[i] : plain.at[i + 1]]
        assert original.isspace() if c == " " else locate.PLAIN.get(ord(original), original) == c


def test_locate_reasons():
    body = locate.plain("Das „Fieber“ stieg.  Kein Fieber, Fieberkurve; Fieber – hoch.")
    at = lambda *a: locate.locate(body, *a)
    assert at(" x", "c", None)[2] == "phrase_not_trimmed"
    assert at("Husten", "kein Husten", None)[2] == "context_not_found"
    assert at("Fieber", "Fieber", None)[2] == "context_not_unique"
    assert at("Husten", "Kein Fieber", None)[2] == "phrase_not_in_context"
    assert at("Fieber", 'Das "Fieber" stieg', None)[:2] == (5, 11)
    assert at("Fieber", "Kein Fieber, Fieberkurve", None)[:2] == (26, 32)
    assert at("Fieber", "Kein Fieber, Fieberkurve", 2)[:2] == (34, 40)
    assert at("Fieber", "Kein Fieber, Fieberkurve", 3)[2] == "occurrence_out_of_range"
    assert at("e", "Fieber - hoch", None)[2] == "phrase_not_unique_in_context"


def test_greedy_spans_keep_arrival_order(spark):
    rows = spark.createDataFrame([([(0, 5), (3, 8), (5, 6), (8, 9), (7, 9)],)], "s array<struct<start:int,end:int>>")
    kept = rows.select(locate.without_overlaps(F.col("s")).alias("k")).first().k
    assert [tuple(k) for k in kept] == [(0, 5), (5, 6), (8, 9)]


def test_passages_in_blocks(spark):
    docs = spark.createDataFrame([(1, "xabcabcx"), (2, None), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "abc"), (8, "bca"), (9, ""), (10, None), (11, "abc")], "item_id long, text string")
    for chars in (3, 1000):
        found = sorted(map(tuple, locate.passages(docs, items, block_chars=chars).collect()))
        assert found == [(1, 7, 1, 4), (1, 7, 4, 7), (1, 8, 2, 5), (1, 11, 1, 4), (1, 11, 4, 7)]


def test_canonical_json():
    assert hashing.canonical_json({"b": [1, True, None], "a": "é\n\u001f"}) == '{"a":"é\\n\\u001f","b":[1,true,null]}'


def test_seeded_hash_and_decimal_text(spark):
    import hashlib

    assert one(spark, hashing.seeded("s", F.col("v")), v="x") == hashlib.sha256(b"s\0x").hexdigest()
    row = spark.sql("select cast('1.190340000' as decimal(20,9)) a, cast('5' as decimal(5,0)) b, cast('2.00' as decimal(5,2)) c")
    assert list(row.select(*(hashing.decimal_text(F.col(c)) for c in "abc")).first()) == ["1.19034", "5", "2"]
    assert one(spark, hashing.strict_date(F.col("v")), v="2024-02-30") is None


def test_folding(spark):
    assert text.fold_text("Größe  µm É") == "grosse μm e"
    assert one(spark, text.percent_encode(F.col("v")), v="A/B ~*é") == "A%2FB%20~%2A%C3%A9"
