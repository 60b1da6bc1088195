import pytest
from pyspark.sql import functions as F

from formweave.functions.crypto import EnvelopeCipher, Pseudonyms

from conftest import KEK


def test_round_trip_and_fresh_ciphertext(spark, cipher):
    rows = cipher.with_data_key(spark.range(50).withColumn("v", F.lit("same")), "id")
    sealed = rows.select("id", "v", cipher.seal_text(F.col("v")).alias("s")).persist()
    assert sealed.select("s").distinct().count() == 50
    assert sealed.where(cipher.open_text("s") == F.col("v")).count() == 50
    sealed.unpersist()


def test_rotation_keeps_old_values_readable(spark):
    cipher = EnvelopeCipher(spark, {KEK: b"k" * 32}, KEK, 2)
    old = cipher.with_data_key(spark.range(5), "id").select("id", cipher.seal_text(F.lit("x")).alias("s")).collect()
    cipher.rotate()
    again = spark.createDataFrame([(r.id, r.s) for r in old], "id bigint, s string")
    assert [r[0] for r in again.select(cipher.open_text("s")).collect()] == ["x"] * 5


def test_bad_envelopes_open_to_null(spark, cipher):
    good = cipher.with_data_key(spark.range(1), "id").select(cipher.seal(F.encode(F.lit("x"), "UTF-8")).alias("p"))
    payload = bytes(good.first().p)
    bad = [payload[:-1] + bytes([payload[-1] ^ 1]), payload[:20], b"", b"\xff\xff\xff\xff" + payload[4:], payload[:4]]
    frame = spark.createDataFrame([(b,) for b in bad], "p binary")
    assert [r[0] for r in frame.select(cipher.open("p")).collect()] == [None] * len(bad)


def test_other_or_missing_key_opens_nothing(spark, cipher):
    sealed = cipher.with_data_key(spark.range(1), "id").select(cipher.seal_text(F.lit("x")).alias("s")).collect()
    frame = spark.createDataFrame([(sealed[0].s,)], "s string")
    for other in (EnvelopeCipher(spark, {KEK: b"z" * 32}, KEK, 1), EnvelopeCipher(spark, {}, KEK, 1)):
        assert frame.select(other.open_text("s")).first()[0] is None


def test_plain_text_is_no_envelope(spark, cipher):
    frame = spark.createDataFrame([("AAA",), ("AAAAPA==",), ("plain",), (None,)], "s string")
    assert [r[0] for r in frame.select(cipher.open_text("s")).collect()] == [None] * 4


def test_plans_show_no_key_material(spark, cipher):
    rows = cipher.with_data_key(spark.range(3), "id").select(cipher.seal_text(F.lit("x")).alias("s"))
    rows = rows.select(cipher.open_text("s"))
    shown = rows._jdf.queryExecution().toString().upper()
    assert bytes(range(32)).hex().upper() not in shown and "00 01 02 03" not in shown


@pytest.mark.parametrize("key, data, digest", [
    (b"\x0b" * 20, "Hi There", "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
    (b"Jefe", "what do ya want for nothing?", "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
    (b"\xaa" * 131, "Test Using Larger Than Block-Size Key - Hash Key First",
     "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54")])
def test_pseudonyms_match_published_vectors(spark, key, data, digest):
    """RFC 4231, cases 1, 2 and 6."""
    hashes = Pseudonyms(spark, key)
    rows = hashes.with_hash_key(spark.createDataFrame([(data,), (None,)], "v string"))
    assert [r[0] for r in rows.select(hashes.of(F.col("v"))).collect()] == [digest, None]


def test_a_message_names_its_key(spark):
    ring = {"k1": b"1" * 32, "k2": b"2" * 32}
    sealed = []
    for name in ("k1", "k2", "k3"):
        cipher = EnvelopeCipher(spark, ring | {"k3": b"3" * 32}, name, 1)
        rows = cipher.with_data_key(spark.range(1), "id").select(cipher.seal(F.encode(F.lit(name), "UTF-8")).alias("p"))
        sealed += [(bytes(rows.first().p), n) for n in (name, None)]
    opener = EnvelopeCipher(spark, ring, "k1", 1)
    frame = spark.createDataFrame(sealed, "p binary, n string")
    got = [r[0] and bytes(r[0]).decode() for r in frame.select(opener.open("p", F.col("n"))).collect()]
    assert got == ["k1", "k1", "k2", None, None, None]


def test_values_of_a_row_open_as_often_as_they_are_sealed(spark, cipher):
    """Layers under one data key and under others, beside texts that only look like envelopes; as `open_text` has it."""
    def layered(slot, times):
        row = cipher.with_data_key(spark.range(1).select(F.lit(slot).alias("id"), F.lit("x y").alias("s")), "id")
        for _ in range(times):
            row = row.withColumn("s", cipher.seal_text(F.col("s")))
        return row.first().s

    once, twice, thrice, other = layered(1, 1), layered(1, 2), layered(1, 3), layered(2, 2)
    foreign = EnvelopeCipher(spark, {KEK: b"z" * 32}, KEK, 1)
    strange = foreign.with_data_key(spark.range(1), "id").select(foreign.seal_text(F.lit("x"))).first()[0]
    harmed = once[:-6] + ("A" if once[-6] != "A" else "B") + once[-5:]
    odd = [None, "", "plain", "AAA", "AAAAPA==", "AAAAx==\n", "AAAAx=", "AAAA====", "AAAé", once + "\n", once.rstrip("="),
           once[:40] + " " + once[40:], "=" + once, harmed, strange]
    rows = [[thrice, "n", once, other, twice], [strange, thrice, other], odd, [*reversed(odd), thrice], [], None]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, v array<string>")
    got = {r.id: r.opened for r in cipher.with_opened(frame, F.col("v"), "opened", 3).collect()}

    def one_by_one(values):
        cells = spark.createDataFrame([(i, v, 0) for i, v in enumerate(values)], "i int, v string, n int")
        for _ in range(3):
            cells = cells.withColumn("t", cipher.open_text("v")).select(
                "i", F.coalesce("t", "v").alias("v"), (F.col("n") + F.col("t").isNotNull().cast("int")).alias("n"))
        return [(r.v, r.n) for r in sorted(cells.collect())]

    assert got[5] is None and [tuple(o) for o in got[0]] == [("x y", 3), ("n", 0), ("x y", 1), ("x y", 2), ("x y", 2)]
    for i, values in enumerate(rows[:4]):
        assert [tuple(o) for o in got[i]] == one_by_one(values)


def test_plans_of_rows_show_no_key_material(spark, cipher):
    frame = spark.createDataFrame([(["x"],)], "v array<string>")
    shown = cipher.with_opened(frame, F.col("v"), "o", 3)._jdf.queryExecution().toString().upper()
    assert bytes(range(32)).hex().upper() not in shown and "00 01 02 03" not in shown
