"""Tokens with exact character offsets and token-level views.

Tokenisation is row-local: ``regexp_extract_all`` splits a text into pieces
that cover every character (whitespace runs, word runs, single other chars),
a running sum over a batch turns piece lengths into offsets, and whitespace
pieces are dropped: O(n).  Nothing is exploded or shuffled; a 30k-token line
costs the same as 30k one-token lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions.arrays import pin
from spanforge.functions.text import TOKEN_PATTERN

TOKENS_T = "array<struct<i:int,text:string,start:int,stop:int,ws:boolean>>"
_BLANKS = ["\t", "\n", "\x0b", "\f", "\r", " "]


def tokenize(df: DataFrame, text_col: str = "sentence", out: str = "tokens") -> DataFrame:
    """Add ``out: array<struct<i,text,start,stop,ws>>`` (G1).

    ``ws`` is true when the token is followed by whitespace (used by G12).  The JVM cuts
    the text; the offsets of an Arrow batch of texts are one running sum, a few vector
    operations for all their pieces, where array expressions would walk them some
    twenty times, an element at a time.
    """
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_PATTERN), F.lit(0))
    return df.withColumn(out, pin(F.arrow_udf(_placed(), TOKENS_T)(pieces)))


def _placed() -> Callable[[pa.Array], pa.Array]:
    """The tokens of a batch of texts cut into pieces: a function that workers get whole,
    as they need not have this module."""
    def placed(pieces: pa.Array) -> pa.Array:
        flat, missing = pieces.flatten().cast(pa.string()), pieces.is_null()
        sizes = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        last = np.cumsum(sizes)                      # a text's pieces are first .. last - 1
        first = last - sizes
        lengths = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.concatenate(([0], np.cumsum(lengths)))
        stops = sums[1:] - np.repeat(sums[first], sizes)
        blank = pc.is_in(pc.utf8_slice_codeunits(flat, 0, 1), pa.array(_BLANKS)).to_numpy(zero_copy_only=False)
        spaced = np.concatenate((blank[1:], [False]))[:len(blank)]
        spaced[last[sizes > 0] - 1] = False
        kept = ~blank
        before = np.concatenate(([0], np.cumsum(kept)))
        counts = before[last] - before[first]
        offsets = np.concatenate(([0], np.cumsum(counts)))
        i = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts)
        told = pa.StructArray.from_arrays(
            [pa.array(i, pa.int32()), flat.filter(pa.array(kept)), pa.array((stops - lengths)[kept], pa.int32()),
             pa.array(stops[kept], pa.int32()), pa.array(spaced[kept])], names=["i", "text", "start", "stop", "ws"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), told, mask=missing)

    return placed


def explode_tokens(df: DataFrame, keys: list[str], tokens: str = "tokens") -> DataFrame:
    """One row per token: keys + i, token, start, stop, ws.

    ``inline_outer`` + a null filter instead of ``inline``: the optimizer
    infers ``size(arr) > 0`` for a plain generator and pushes it down with the
    whole array expression substituted."""
    return (df.select(*keys, F.inline_outer(tokens)).where(F.col("i").isNotNull())
            .withColumnRenamed("text", "token"))


def encoded(rows: DataFrame, keys: list[str], token: str = "token", rows_at_once: int = 1 << 20) -> DataFrame:
    """H8: tokens as numbers, the occurrences of a stretch of rows put together by term:
    ``term`` and ``term_id`` (the first 60 bits of its md5), once a stretch of about
    ``rows_at_once`` rows, and an array of each of the ``keys``."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(["term string, term_id long", *(f"`{k}` array<{kinds[k]}>" for k in keys)])
    return rows.select(*keys, token).mapInArrow(_by_term(keys, token, rows_at_once), schema)


def _by_term(keys: list[str], token: str, rows_at_once: int, bytes_at_once: int = 1 << 26) -> Callable:
    """A function that workers get whole, as they need not have this module."""
    def put_together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        codes = table[token].cast(pa.string()).dictionary_encode()
        terms, at = codes.dictionary, codes.indices.to_numpy()
        order = pa.array(np.argsort(at, kind="stable"))
        offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(terms))))), pa.int32())
        ids = [int.from_bytes(hashlib.md5(t).digest()[:8]) >> 4 for t in terms.cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [terms, pa.array(ids, pa.int64()), *(pa.ListArray.from_arrays(offsets, table[k].take(order)) for k in keys)],
            names=["term", "term_id", *keys])

    def by_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            batch = batch.filter(batch[token].is_valid())
            if len(batch):
                held.append(batch)
                rows, size = rows + len(batch), size + batch.nbytes
            if rows >= rows_at_once or size >= bytes_at_once:
                yield put_together(held)
                held, rows, size = [], 0, 0
        if held:
            yield put_together(held)

    return by_term


def token_texts(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: t["text"])


def truncate_with_specials(tokens: Column, max_len: int | None = None,
                           cls: str = "[CLS]", sep: str = "[SEP]") -> Column:
    """``[CLS] + first (max_len-2) tokens + [SEP]``; specials get (0, 0).
    Without ``max_len`` all tokens stay."""
    def special(name):
        return F.array(F.struct(F.lit(-1).alias("i"), F.lit(name).alias("text"), F.lit(0).alias("start"),
                                F.lit(0).alias("stop"), F.lit(False).alias("ws")))
    body = tokens if max_len is None else F.slice(tokens, 1, max_len - 2)
    return F.concat(special(cls), body, special(sep))


def detokenize(words: Column, spaces: Column) -> Column:
    """Rebuild text from words and trailing-space flags."""
    return F.array_join(
        F.zip_with(words, spaces, lambda w, s: F.concat(w, F.when(s, F.lit(" ")).otherwise(F.lit("")))), "")


def token_slice_text(text: Column, tokens: Column, first: Column, end: Column) -> Column:
    """Text of tokens ``[first, end)``, inner whitespace kept."""
    start = F.get(tokens, first)["start"]
    stop = F.get(tokens, end - 1)["stop"]
    return F.when((first >= 0) & (end > first) & (end <= F.size(tokens)),
                  F.substring(text, start + 1, stop - start))


def strided_windows(tokens: Column, size: int = 128, stride: int = 96) -> Column:
    """Windows of ``size`` tokens every ``stride`` tokens.

    A window starts at every multiple of ``stride`` below ``n``; a tail window
    wholly inside its predecessor (start + size of the previous >= n) is not
    emitted, so every token is covered and no window is redundant.
    """
    n = F.size(tokens)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(stride)),
                      lambda s: (s == 0) | (s - stride + size < n))
    return F.when(n > 0, F.transform(starts, lambda s: F.struct(
        s.alias("first_tok"), F.least(s + size, n).alias("end_tok"),
        F.slice(tokens, s + 1, size).alias("tokens")))).otherwise(F.array().cast(
            "array<struct<first_tok:int,end_tok:int,tokens:array<struct<i:int,text:string,start:int,stop:int,ws:boolean>>>>"))
