"""Envelope encryption with Spark's AES functions.

A payload is ``length(4, big endian) | wrapped data key | iv(12) | ciphertext | tag(16)``: the value is
sealed with a data key, and the data key with the key-encrypting key (KEK). Key material never appears as
a literal: plans hold scalar subqueries over small driver-side tables, so ``explain`` shows no secret.

GCM with random 96-bit IVs is safe for about 2**32 uses of one key. A cipher therefore holds a pool of data
keys and picks one by a hash of the row's id; ``data_keys`` times 2**32 values may be sealed per pool.
"""

from __future__ import annotations

import hashlib
import hmac
import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.functions.text import base64_text, utf8_bytes, utf8_text

# Data keys, each with what its envelopes start with: length and bytes of the wrapped key.
_POOL = T.StructType([T.StructField("pool", T.ArrayType(T.StructType([
    T.StructField("dek", T.BinaryType()), T.StructField("header", T.BinaryType())])))])
_KEK = T.StructType([T.StructField("kek_id", T.StringType()), T.StructField("kek", T.BinaryType())])

_PADS = T.StructType([T.StructField("pads", T.StructType([
    T.StructField("inner", T.BinaryType()), T.StructField("outer", T.BinaryType())]))])

DATA_KEY = "_data_key"
HASH_KEY = "_hash_key"
KEK = "_kek"
# Message attribute that names the KEK a payload is sealed under.
KEY_NAME = "keyName"
# What the key of pseudonyms is derived for.
PSEUDONYMS = b"pseudonyms"

# Fixed value: Base64 of an envelope; its first two bytes are zero, as wrapped keys are short.
ENVELOPE_TEXT = "^AAA[A-Za-z0-9+/]+={0,2}$"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _envelope(value: Column) -> Column:
    """Bytes of a text that looks like an envelope, NULL for others. Where the bytes account for every character of a
    padded text, none was passed over in decoding, and the costlier test of its form is not needed."""
    quads, padding = F.shiftright(F.octet_length(value), 2), F.when(F.endswith(value, F.lit("==")), 2).when(
        F.endswith(value, F.lit("=")), 1).otherwise(0)

    def told(raw: Column) -> Column:
        counted = (F.octet_length(value) == quads * 4) & (F.length(raw) == quads * 3 - padding)
        return F.when(counted | F.rlike(value, F.lit(ENVELOPE_TEXT)), raw)

    return F.when(F.startswith(value, F.lit("AAA")), _once(F.try_to_binary(value, F.lit("base64")), told))


def _key_size(envelope: Column) -> Column:
    """Length of the wrapped key, NULL if the envelope cannot hold it."""
    length = F.conv(F.hex(F.substring(envelope, 1, 4)), 16, 10).cast("bigint")
    return F.when(length.between(1, F.length(envelope) - 4), length).cast("int")


class Pseudonyms:
    """HMAC-SHA256 of values as column expressions: equal values have equal pseudonyms, in all tables and runs, and
    nobody without the key can tell which value one stands for. The padded keys are a constant of the plan."""

    def __init__(self, spark: SparkSession, key: bytes | None):
        if key is not None and len(key) > 64:
            key = hashlib.sha256(key).digest()
        pads = (None, None) if key is None else tuple(bytes(k ^ pad for k in key.ljust(64, b"\0")) for pad in (0x36, 0x5C))
        self._pads = spark.createDataFrame([(pads,)], _PADS)

    def with_hash_key(self, df: DataFrame) -> DataFrame:
        return df.withColumn(HASH_KEY, self._pads.select("pads").scalar())

    @staticmethod
    def of(value: Column) -> Column:
        """64 hexadecimal digits under the row's hash key; NULL for NULL, and where there is no key."""
        key = F.col(HASH_KEY)
        return F.sha2(F.concat(key["outer"], F.unhex(F.sha2(F.concat(key["inner"], utf8_bytes(value)), 256))), 256)


class EnvelopeCipher:
    """Seals values under one named KEK and opens those of any KEK in a key map ``{resource name: 32 bytes}``."""

    def __init__(self, spark: SparkSession, key_map: dict[str, bytes], kek_id: str, data_keys: int = 256):
        self._keks = spark.createDataFrame(list(key_map.items()), _KEK)
        self._kek_id = kek_id
        kek = key_map.get(kek_id)
        self.pseudonyms = Pseudonyms(spark, None if kek is None else hmac.digest(kek, PSEUDONYMS, "sha256"))
        self._count = data_keys
        self._spark = spark
        self._pool: DataFrame | None = None

    @property
    def _kek(self) -> Column:
        """The KEK, or NULL when the key map does not hold it."""
        return self._keks.where(F.col("kek_id") == self._kek_id).select("kek").scalar()

    @property
    def key_name(self) -> str:
        return self._kek_id

    def _kek_named(self, name: Column) -> Column:
        """The KEK of that name, or NULL when the key map does not hold it."""
        ring = self._keks.agg(F.map_from_entries(F.collect_list(F.struct("kek_id", "kek"))).alias("ring"))
        return ring.scalar()[name]

    def rotate(self) -> None:
        """Make a new pool of data keys; values sealed before stay readable."""
        fresh = self._spark.createDataFrame([(secrets.token_bytes(32),) for _ in range(self._count)], "dek binary")
        wrapped = fresh.select("dek", F.aes_encrypt("dek", self._kek, F.lit("GCM")).alias("wrapped"))
        pool = [(r.dek, len(r.wrapped).to_bytes(4, "big") + r.wrapped) for r in wrapped.collect() if r.wrapped]
        self._pool = self._spark.createDataFrame([(pool,)], _POOL)

    def with_data_key(self, df: DataFrame, *by: str) -> DataFrame:
        """Add the data key of each row. No join and no shuffle: the pool is a constant of the plan."""
        if self._pool is None:
            self.rotate()
        slot = F.pmod(F.xxhash64(*by), F.lit(self._count)).cast("int")
        return df.withColumn(DATA_KEY, F.get(self._pool.select("pool").scalar(), slot))

    @staticmethod
    def seal(value: Column) -> Column:
        """BINARY envelope of a BINARY value, using the row's data key; NULL when there is no key."""
        key = F.col(DATA_KEY)
        return F.concat(key["header"], F.aes_encrypt(value, key["dek"], F.lit("GCM")))

    @staticmethod
    def seal_text(value: Column) -> Column:
        """Base64 envelope of a text value, as stored in a protected column."""
        return base64_text(EnvelopeCipher.seal(utf8_bytes(value)))

    def open(self, envelope: Column | str, name: Column | None = None) -> Column:
        """The sealed BINARY value, or NULL for a wrong key, a tampered or a truncated envelope. ``name`` is the row's
        key; the cipher's own is used where it is NULL."""
        kek = self._kek if name is None else F.when(name.isNull(), self._kek).otherwise(self._kek_named(name))
        return self._open(F.col(envelope) if isinstance(envelope, str) else envelope, kek)

    @staticmethod
    def _open(envelope: Column, kek: Column) -> Column:
        size = _key_size(envelope)
        dek = F.try_aes_decrypt(F.substring(envelope, F.lit(5), size), kek, F.lit("GCM"))
        body = F.substring(envelope, size + 5, F.length(envelope))
        return F.try_aes_decrypt(body, dek, F.lit("GCM"))

    def open_text(self, value: Column | str) -> Column:
        """Text of a protected column, or NULL for text that is no envelope. Plain text is told apart by its
        form first, because failing to decode costs much more than the test."""
        value = F.col(value) if isinstance(value, str) else value
        looks_sealed = F.rlike(value, F.lit(ENVELOPE_TEXT))
        return F.when(looks_sealed, utf8_text(self.open(F.try_to_binary(value, F.lit("base64")))))

    def with_opened(self, df: DataFrame, values: Column, into: str, times: int) -> DataFrame:
        """Add `into`, an array of (value, times) in the order of the array of texts ``values``: each text opened as often
        as it was sealed, up to so many times, as `open_text` does, and how often that was.

        The values of a row are mostly sealed under one data key. The key that the first envelope names is unwrapped once
        for the row, and serves all that begin alike; others have theirs unwrapped. The plan does not grow with the number
        of values, so that its code stays small enough to be compiled.
        """
        kek = F.col(KEK)

        def named(cells: Column) -> Column:
            first = F.get(F.filter(F.transform(cells, lambda c: c["envelope"]), lambda e: e.isNotNull()), F.lit(0))
            return _once(first, lambda e: _once(_key_size(e), lambda size: F.struct(
                F.substring(e, F.lit(1), size + 4).alias("header"),
                F.try_aes_decrypt(F.substring(e, F.lit(5), size), kek, F.lit("GCM")).alias("dek"))))

        def body(envelope: Column, key: Column) -> Column:
            size = F.length(key["header"])
            inner = F.try_aes_decrypt(F.substring(envelope, size + 1, F.length(envelope)), key["dek"], F.lit("GCM"))
            return F.when(F.substring(envelope, F.lit(1), size) == key["header"], inner).otherwise(self._open(envelope, kek))

        def opened(cells: Column, key: Column, last: bool) -> Column:
            def cell(value: Column, times: Column, envelope: Column) -> Column:
                return F.struct(value.alias("value"), times.alias("times"), envelope.alias("envelope"))

            def inner(c: Column) -> Column:
                none = F.lit(None).cast("binary")
                return _once(utf8_text(body(c["envelope"], key)), lambda text: F.when(
                    text.isNull(), cell(c["value"], c["times"], none)).otherwise(
                    cell(text, c["times"] + 1, none if last else _envelope(text))))

            return F.transform(cells, lambda c: F.when(c["envelope"].isNull(), c).otherwise(inner(c)))

        def layers(cells: Column, key: Column) -> Column:
            for i in range(times):
                cells = opened(cells, key, i == times - 1)
            return F.transform(cells, lambda c: F.struct(c["value"].alias("value"), c["times"].alias("times")))

        sealed = F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(0).alias("times"), _envelope(v).alias("envelope")))
        # A subquery may not stand within a function of arrays: the KEK becomes a column first.
        return df.withColumn(KEK, self._kek).withColumn(
            into, _once(sealed, lambda cells: _once(named(cells), lambda key: layers(cells, key)))).drop(KEK)
