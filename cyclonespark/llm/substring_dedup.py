"""Substring dedup: fixed-block anchors.

A repeated window of 35 words holds a whole non-overlapping block of 18 words of the text
it is taken from, wherever that begins.  So the blocks of all texts are the index, every
rolling window of 18 words of every text probes it, and only windows of 35 words around a
hit are compared; overlapping repeated windows are the maximal exact repeats.

Texts are dealt to groups of about ``GROUP_BYTES``; a group sends each distinct hash once,
so a passage that a third of all texts share is one row a group, and no pair of
occurrences is ever formed:

1. each group sends its distinct hashes of rolling 18-word windows, 30 bits and two flags (is a block,
   occurs twice here), to hash buckets of bounded size; a bucket answers each group with
   the hashes that some block anywhere and another window share;
2. each group sends its distinct 35-word windows around those hits, 95 bits and a flag; a bucket answers
   with those that occur twice or more;
3. each group marks the words that these windows cover.

Step 1 is only a filter, whose chance hits step 2 removes; step 2 compares 95-bit hashes.

Nulls and edge cases: a null text has no words; repeated rows repeat each other's windows, so with 35 words
or more they lose all of them; an empty table gives no rows; extra columns are ignored
(``remove_repeats``) or kept (``dedup``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import lean_group, lean_groups, ship
from cyclonespark.llm.hashing import U, chunks, windows, words_of

WINDOW = 35
GROUP_BYTES = 5_000_000
#: windows of a hash bucket, on average
BUCKET_WINDOWS = 1_000_000

_BLOBS = "bucket long, pid long, blob binary"


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _texts(frame: pd.DataFrame) -> list[bytes]:
    return [b"" if t is None else bytes(t) for t in frame["_body"]]


def _anchors(texts: list[bytes], block: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all rolling windows of ``block`` words of texts that hold a whole window, and which of them are blocks."""
    hashes, blocks = [], []
    for _, part in chunks(texts):
        w = words_of(part)
        at, h = windows(w, block)
        owner_first = np.repeat(w.first[:-1], w.counts)[at]
        hashes.append(h)
        blocks.append((at - owner_first) % block == 0)
    return np.concatenate(hashes or [np.zeros(0, U)]), np.concatenate(blocks or [np.zeros(0, bool)])


def _send(pid: int, bucket: np.ndarray, values: np.ndarray, buckets: int) -> pd.DataFrame:
    """One row a bucket with its values, which are in the order of their buckets."""
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = [(b, pid, values[cuts[b] : cuts[b + 1]].tobytes()) for b in np.flatnonzero(np.diff(cuts)).tolist()]
    return pd.DataFrame(rows, columns=["bucket", "pid", "blob"])


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Begins of runs of equal keys in sorted arrays."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _probe(block: int, buckets: int):
    def send(frame: pd.DataFrame) -> pd.DataFrame:
        h, is_block = _anchors(_texts(frame), block)
        order = np.argsort(h, kind="stable")
        h, is_block = h[order], is_block[order]
        if not len(h):
            return pd.DataFrame({"bucket": [], "pid": [], "blob": []})
        at = _runs(h)
        flags = np.maximum.reduceat(is_block.astype(np.uint32), at) | (np.diff(at, append=len(h)) > 1).astype(np.uint32) << 1
        values = ((h[at] & U(0x3FFFFFFF)) << U(2)).astype(np.uint32) | flags.astype(np.uint32)
        return _send(int(frame["_pid"].iloc[0]), _bucket(h[at], buckets), values, buckets)

    return send


def _answer_probe(frame: pd.DataFrame) -> pd.DataFrame:
    blobs = [np.frombuffer(b, np.uint32) for b in frame["blob"]]
    values = np.concatenate(blobs)
    pids = np.repeat(frame["pid"].to_numpy(), [len(b) for b in blobs])
    order = np.argsort(values >> 2, kind="stable")
    values, pids = values[order], pids[order]
    at = _runs(values >> 2)
    size = np.diff(at, append=len(values))
    flags = np.bitwise_or.reduceat(values & 3, at)
    hit = np.repeat(((flags & 1) == 1) & ((size > 1) | (flags > 1)), size)
    return _reply(frame["bucket"].iloc[0], pids[hit], (values[hit] >> 2).astype(np.uint32))


def _reply(bucket: int, pids: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    order = np.argsort(pids, kind="stable")
    pids, values = pids[order], values[order]
    at = [*_runs(pids).tolist(), len(pids)]
    rows = [(bucket, int(pids[a]), values[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)]
    return pd.DataFrame(rows, columns=["bucket", "pid", "blob"])


def _candidates(texts: list[bytes], hits: np.ndarray, block: int, window: int, buckets: int):
    """For each chunk: its words, start indexes and two hashes of the windows around hits."""
    for begin, part in chunks(texts):
        w = words_of(part)
        at, h = windows(w, block)
        key = (_bucket(h, buckets).astype(U) << U(30)) | (h & U(0x3FFFFFFF))
        hot = np.zeros(len(w.hash) + 1, np.int64)
        if len(hits):
            place = np.minimum(np.searchsorted(hits, key), len(hits) - 1)
            hot[1 + at[hits[place] == key]] = 1
        hot = np.cumsum(hot)
        starts, a = windows(w, window)
        near = hot[starts + window - block + 1] > hot[starts]
        _, b = windows(w, window, salt=7)
        yield begin, part, w, starts[near], a[near], b[near]


def _hits(reply: pd.DataFrame) -> np.ndarray:
    parts = [(U(b) << U(30)) | np.frombuffer(x, np.uint32).astype(U) for b, x in zip(reply["bucket"], reply["blob"], strict=True)]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, U)


_PAIR = np.dtype([("a", "<u8"), ("b", "<u4")])


def _compare(block: int, window: int, buckets: int):
    def send(frame: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if not len(frame) or not len(reply):
            return pd.DataFrame({"bucket": [], "pid": [], "blob": []})
        found = [(a, b) for *_, a, b in _candidates(_texts(frame), _hits(reply), block, window, buckets)]
        a, b = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]) >> U(33)
        if not len(a):
            return pd.DataFrame({"bucket": [], "pid": [], "blob": []})
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        at = _runs(a, b)
        values = np.zeros(len(at), _PAIR)
        values["a"] = a[at]
        values["b"] = (b[at] << U(1)).astype(np.uint32) | (np.diff(at, append=len(a)) > 1)
        return _send(int(frame["_pid"].iloc[0]), _bucket(a[at], buckets), values, buckets)

    return send


def _answer_compare(frame: pd.DataFrame) -> pd.DataFrame:
    blobs = [np.frombuffer(b, _PAIR) for b in frame["blob"]]
    values = np.concatenate(blobs)
    pids = np.repeat(frame["pid"].to_numpy(), [len(b) for b in blobs])
    a, b = values["a"], values["b"]
    order = np.lexsort((b >> 1, a))
    a, b, pids = a[order], b[order], pids[order]
    at = _runs(a, b >> 1)
    size = np.diff(at, append=len(a))
    again = np.repeat((size > 1) | (np.bitwise_or.reduceat(b & 1, at) > 0), size)
    return _reply(frame["bucket"].iloc[0], pids[again], a[again])


def _mark(block: int, window: int, buckets: int, text_out: bool):
    def marked(frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        """``replies``: kind 0 the hits, kind 1 the repeated windows."""
        texts = _texts(frame)
        hits = _hits(replies[replies["kind"] == 0])
        again = replies[replies["kind"] == 1]["blob"]
        again = np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in again])) if len(again) else np.zeros(0, U)
        n_words, n_removed, digests, kept_texts, spans = [], [], [], [], []
        for _, part, w, at, a, _ in _candidates(texts, hits, block, window, buckets):
            cover = np.zeros(len(w.hash) + 1, np.int64)
            if len(again) and len(at):
                place = np.minimum(np.searchsorted(again, a), len(again) - 1)
                at = at[again[place] == a]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            for i, text in enumerate(part):
                lo, hi = int(w.first[i]), int(w.first[i + 1])
                mine = gone[lo:hi]
                removed = int(mine.sum())
                n_words.append(hi - lo)
                n_removed.append(removed)
                if not removed:
                    digests.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                    kept_texts.append(text if text_out else None)
                    spans.append(None)
                    continue
                edge = np.flatnonzero(np.diff(mine.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
                split, kept, out, word, byte = text.split(), [], [], 0, int(w.begin[lo])
                byte = base = int(np.sum([len(t) + 1 for t in part[:i]])) if text_out else 0
                for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    kept += split[word:s]
                    word = e
                    if text_out:
                        out.append(w.data[byte : int(w.begin[lo + s])])
                        byte = int(w.end[lo + e - 1])
                kept += split[word:]
                if text_out:
                    out.append(w.data[byte : base + len(text)])
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                kept_texts.append(b"".join(out) if text_out else None)
                spans.append([int(x) for x in edge])
        rest = frame.drop(columns=["_pid", "_body"])
        return rest.assign(n_words=np.asarray(n_words, "int64"), n_removed=np.asarray(n_removed, "int64"), kept_sha256=digests, _kept=kept_texts, spans=spans)

    return marked


def dedup(docs: DataFrame, window: int = WINDOW, text: str = "text", text_out: bool = True) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_removed, kept_sha256 (of the kept words joined by one
    space), spans (begins and ends of the removed runs, in words, one after the other; null: none)
    and, with ``text_out``, kept_text: the text without the removed runs, white space around them as it was.
    """
    ship(docs.sparkSession)
    block = (window + 1) // 2
    clash = [c for c in ("n_words", "n_removed", "kept_sha256", "spans", "kept_text") if c in docs.columns]
    docs = docs.drop(*clash)
    others = [c for c in docs.columns if c != text]
    size = docs.agg(F.sum(F.octet_length(F.col(text)) + 1).alias("bytes")).first()["bytes"] or 1
    groups = max(1, -(-size // GROUP_BYTES))
    buckets = max(1, -(-size // (6 * BUCKET_WINDOWS)))
    rows = docs.select(*others, F.encode(F.col(text), "utf-8").alias("_body"))
    rows = rows.withColumn("_pid", F.pmod(F.xxhash64(*[F.col(c) for c in others if c == "doc_id"], "_body"), F.lit(groups)))
    bodies = rows.groupBy("_pid")

    by_bucket = bodies.applyInPandas(lean_group(_probe(block, buckets)), _BLOBS).groupBy("bucket")
    hits = by_bucket.applyInPandas(lean_group(_answer_probe), _BLOBS)
    compared = bodies.cogroup(hits.groupBy("pid")).applyInPandas(lean_groups(_compare(block, window, buckets)), _BLOBS)
    again = compared.groupBy("bucket").applyInPandas(lean_group(_answer_compare), _BLOBS)
    replies = hits.withColumn("kind", F.lit(0)).unionByName(again.withColumn("kind", F.lit(1)))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("_pid", "_body")] + ["n_words long, n_removed long, kept_sha256 string, _kept binary, spans array<int>"])
    out = bodies.cogroup(replies.groupBy("pid")).applyInPandas(lean_groups(_mark(block, window, buckets, text_out)), schema)
    kept = F.decode("_kept", "utf-8").alias("kept_text")
    return out.select(*others, "n_words", "n_removed", "kept_sha256", "spans", *([kept] if text_out else []))
