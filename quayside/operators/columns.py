"""Column transforms. Each adds one projection, however many columns are configured."""

from __future__ import annotations

import hashlib
import hmac
import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import convert, delimited, digest, hmac_pads, keyed_digest, named

MASK_PREFIX = "masked_"

log = logging.getLogger(__name__)


def mask_columns(
    df: DataFrame, names: Iterable[str], drop_source: bool = False, key: bytes | None = None
) -> DataFrame:
    """Append ``masked_<name>``, the SHA-256 of the value's text. The source stays by default.

    With ``key`` the mask is the HMAC-SHA-256 under that key, so that small ids cannot be found
    out by hashing all of them.
    """
    names = list(dict.fromkeys(names))
    if key is None or not names:
        masked = df.withColumns({MASK_PREFIX + name: digest(named(name)) for name in names})
    else:
        with_key, (inner, outer) = _beside(df, *hmac_pads(key))
        masks = {MASK_PREFIX + name: keyed_digest(named(name), inner, outer) for name in names}
        masked = with_key.withColumns(masks).drop(inner, outer)
    return masked.drop(*[named(name) for name in names]) if drop_source else masked


def encrypt_columns(df: DataFrame, names: Iterable[str], key: bytes) -> DataFrame:
    """Replace columns in place by their text under AES-GCM, as Base64; null stays null.

    The key has 16, 24 or 32 bytes. Each value has its own random nonce, so equal values differ.
    """
    with_key, (secret,) = _beside(df, key)
    hidden = {
        name: F.base64(F.aes_encrypt(named(name).cast("string").cast("binary"), secret, F.lit("GCM")))
        for name in names
    }
    return with_key.withColumns(hidden).drop(secret)


def pseudonymise(df: DataFrame, names: Iterable[str], key: bytes) -> DataFrame:
    """Replace columns in place by pseudonyms: equal values have equal ones, and ``decrypt_columns`` undoes them.

    Text is encrypted by AES-GCM under a nonce made from its HMAC-SHA-256, so the nonce repeats only with
    the value; null stays null. Frames under the same key can be joined and grouped by pseudonyms. Unlike
    ``encrypt_columns``, this shows which rows have the same value. The key is ``pseudonym_key(secret)``:
    the HMAC's is derived from it, so one key decrypts.
    """
    inner, outer = hmac_pads(_derived(key, b"nonce"))
    with_key, (secret, first, last) = _beside(df, key, inner, outer)
    hidden = {}
    for name in names:
        text = named(name).cast("string")
        nonce = F.substring(F.unhex(keyed_digest(named(name), first, last)), 1, 12)
        hidden[name] = F.base64(F.aes_encrypt(text.cast("binary"), secret, F.lit("GCM"), F.lit("DEFAULT"), nonce))
    return with_key.withColumns(hidden).drop(secret, first, last)


def pseudonym_key(secret: bytes) -> bytes:
    """A key of 32 bytes for ``pseudonymise`` and for ``decrypt_columns`` after it, from a secret of any length."""
    return _derived(secret, b"pseudonym")


def _derived(secret: bytes, purpose: bytes) -> bytes:
    return hmac.new(secret, purpose, hashlib.sha256).digest()


def decrypt_columns(df: DataFrame, types: Iterable[tuple[str, str]], key: bytes) -> DataFrame:
    """Undo ``encrypt_columns``, into the type given for each column; a wrong key raises."""
    with_key, (secret,) = _beside(df, key)
    shown = {
        name: F.aes_decrypt(F.unbase64(named(name)), secret, F.lit("GCM")).cast("string").cast(to)
        for name, to in types
    }
    return with_key.withColumns(shown).drop(secret)


def _beside(df: DataFrame, *secrets: bytes) -> tuple[DataFrame, list[Column]]:
    """The frame with secrets as columns from a frame of one row: a literal would show in plans."""
    taken, names = {name.lower() for name in df.columns}, []
    for _ in secrets:
        name = "secret"
        while name in taken:
            name += "_"
        taken.add(name)
        names.append(name)
    row = df.sparkSession.createDataFrame([secrets], ", ".join(f"{name} binary" for name in names))
    return df.crossJoin(F.broadcast(row)), [named(name) for name in names]


def cast_columns(
    df: DataFrame, casts: Iterable[tuple[str, str]], strict: bool = False
) -> DataFrame:
    """Replace columns in place by their value in another type; see ``functions.convert``."""
    values: dict[str, Column] = {}
    for name, to in casts:
        # A second cast of a column takes the result of the first.
        dtype = None if name in values else df.schema[name].dataType
        values[name] = convert(values.get(name, named(name)), to, strict, name, dtype)
    return df.withColumns(values)


def join_arrays(df: DataFrame, joins: Iterable[tuple[str, str]]) -> DataFrame:
    """Replace array columns in place by their elements joined by a separator.

    A second separator for a column finds text there and changes nothing.
    """
    values: dict[str, Column] = {}
    for name, separator in joins:
        if name not in values:
            values[name] = delimited(named(name), separator, df.schema[name].dataType)
    return df.withColumns(values)


def copy_partitions(df: DataFrame, partitions: Iterable[tuple[str, str]]) -> DataFrame:
    """Append copies of columns under their partition names.

    Spark leaves partition columns out of the data files; the copies keep the sources in them.
    """
    return df.withColumns(
        {name: named(source) for name, source in partitions if name != source}
    )


def cluster_for_write(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one output folder together, so a task does not write to all folders.

    One shuffle. Adaptive execution sizes its partitions: a folder holding a large share of
    the rows is split over many tasks, small ones are merged. Without adaptive execution a
    hot folder would end in one task, so the rows then stay where they are, and the log says so.
    """
    switches = ["spark.sql.adaptive.enabled"]
    if df.isStreaming:
        switches.append("spark.sql.adaptive.streaming.stateless.enabled")
    adaptive = all(df.sparkSession.conf.get(switch) == "true" for switch in switches)
    if not columns:
        return df
    if not adaptive:
        log.warning("rows are not clustered by %s: adaptive execution is off", list(columns))
        return df
    return df.hint("rebalance", *[named(name) for name in dict.fromkeys(columns)])
