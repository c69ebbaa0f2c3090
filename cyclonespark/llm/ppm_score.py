"""Language-model scores by prediction by partial matching (PPM).

A text is its words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, and one end; the model reads it as
bytes, words joined by one space.  Trie of byte contexts of order 0 to ``ORDER``: a symbol is coded in the
longest context seen in training; a context that has not held it escapes to the next
shorter one, which leaves out (excludes) all symbols of the longer.  With T occurrences of d
symbols that are not excluded, a symbol seen c times has (2c - 1) / 2T and the escape d / 2T (method D);
after order 0 all bytes never seen are equally likely.  The model is trained beforehand
(static), so a document's score does not depend on the others scored.

``base_score`` sums log10((c + 0.5) / (N + 0.5 * (V + 1))) over the words and the end.

On Spark no trie is ever in one place:

1. counts of byte pairs (order 1; at most 256 * 256 rows) go to the driver and to all tasks;
2. texts are dealt to groups of about ``GROUP_BYTES``.  A group sends its distinct grams (context
   and symbol) and words with their training counts, also those only asked for (count 0), to
   buckets: a gram by its last two context bytes, so that all its contexts of
   order 2 and more meet there, a word by its hash;
3. messages of at most ``FAN`` groups are summed, then the sums of a bucket, which make its part
   of the trie; probabilities (words: counts) return the same way to the groups that asked;
4. a group looks up each position of its texts.

Memory: a task holds a group's distinct grams, or a bucket's.  The largest bucket holds
the distinct grams after the most frequent two bytes, about 3% of all in prose; grams grow slower than
texts.  Log-probabilities travel as 32-bit floats (relative error below 1e-7), word counts in full.

Nulls and edge cases: a null text is empty, an empty text is one end; a null doc_id is not held out;
repeated rows count each time; long texts are cut at white space into pieces of about ``PIECE`` bytes that keep their
contexts, so nothing is lost; without training rows every symbol has 1/252 and N = V = 0; an empty table
gives no rows; other columns are ignored, also where their names are those used here.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import ship, stored

ORDER = 5
GROUP_BYTES = 24_000_000
#: groups whose messages to one bucket are summed in one task
FAN = 64
PIECE = 1 << 20
CHUNK = 1 << 22
#: bytes but the five of white space, one blank and the end
SYMBOLS = 252

U = np.uint64
_END = b"\n"  # no word holds it: the end of a text, and what stands before its begin
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_MESSAGE = "kind int, bucket int, part int, pid long, keys binary, counts binary"
_TABLE = "kind int, bucket int, part int, keys binary, counts binary"
_REPLY = "kind int, pid long, keys binary, answers binary, types long"


def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, mod 5, is 1."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 1, F.lit(False))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in runs cut at white space."""
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + PIECE) if len(text) > at + PIECE else None
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


def segments(text: bytes) -> Iterator[tuple[bytes, bytes, list[bytes]]]:
    """(``ORDER`` bytes before, symbols, words) of each piece; the last one's symbols and words have the end."""
    tail, held = _END * ORDER, None
    for words in pieces(text):
        if not words:
            continue
        if held:
            yield tail, held[0], held[1]
            tail = (tail + held[0])[-ORDER:]
        held = ((b" " if held else b"") + b" ".join(words), words)
    body, words = held or (b"", [])
    yield tail, body + _END, [*words, _END]


def _chunked(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, bytes, list[bytes]]]]:
    """Segments of the texts, numbered by text, in lists of about ``CHUNK`` bytes."""
    chunk, held = [], 0
    for i, text in enumerate(texts):
        for before, body, words in segments(text):
            chunk.append((i, before, body, words))
            held += len(body)
            if held >= CHUNK:
                yield chunk
                chunk, held = [], 0
    if chunk:
        yield chunk


def grams(chunk: list[tuple[int, bytes, bytes, list[bytes]]]) -> np.ndarray:
    """For each symbol its context's bytes and itself, as one number."""
    raw = np.frombuffer(b"".join(x for _, before, body, _ in chunk for x in (before, body)), np.uint8)
    n = len(raw) - ORDER
    out = np.zeros(n, U)
    for j in range(ORDER + 1):
        out <<= U(8)
        out |= raw[j : j + n]
    begins = np.cumsum([0] + [ORDER + len(body) for _, _, body, _ in chunk])[:-1]
    is_symbol = np.ones(len(raw), bool)
    is_symbol[(begins[:, None] + np.arange(ORDER)).ravel()] = False
    return out[is_symbol[ORDER:]]


def _begins(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted arrays."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = _begins(keys)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _texts(frame: pd.DataFrame) -> list[bytes]:
    return [b"" if t is None else bytes(t) for t in frame["_body"]]


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(1 << 16, np.int64)
    for frame in batches:
        for chunk in _chunked(_texts(frame)):
            raw = np.frombuffer(b"".join(before[-1:] + body for _, before, body, _ in chunk), np.uint8)
            pair = raw[:-1].astype(np.int64) << 8 | raw[1:]
            ends = np.cumsum([1 + len(body) for _, _, body, _ in chunk])[:-1]
            total += np.bincount(np.delete(pair, ends - 1), minlength=1 << 16)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"pair": at, "n": total[at]})


def _dealt(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each two context bytes: heaviest first to the lightest bucket."""
    weight = pairs.astype(float) ** 0.75
    load, out = [(0.0, b) for b in range(buckets)], np.arange(1 << 16) % buckets
    for pair in np.argsort(-weight, kind="stable")[: np.count_nonzero(pairs)].tolist():
        held, b = heapq.heappop(load)
        out[pair] = b
        heapq.heappush(load, (held + weight[pair], b))
    return out.astype(np.int32)


class Trie:
    """Contexts of order 2 and more from a bucket's grams, of order 1 and 0 from the pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> None:
        """``keys`` sorted; ``counts`` of training, 0 where a gram is only asked for."""
        seen = counts > 0
        keys, counts = keys[seen], counts[seen]
        self.levels = []  # by order: grams, their counts, contexts, occurrences, symbols
        for k in range(ORDER + 1):
            if k < 2:
                all_keys = np.flatnonzero(pairs).astype(U)
                grams_, n = _summed(all_keys & U((1 << 8 * (k + 1)) - 1), pairs[pairs > 0])
            else:
                grams_, n = _summed(keys & U((1 << 8 * (k + 1)) - 1), counts)
            context = grams_ >> U(8)
            at = _begins(context)
            self.levels.append((grams_, n, context[at], np.add.reduceat(n, at) if len(at) else n, np.diff(at, append=len(n))))

    def log10(self, asked: np.ndarray) -> np.ndarray:
        """log10 of each gram's symbol after its context."""
        out, open_ = np.zeros(len(asked)), np.ones(len(asked), bool)
        gone_n, gone_d = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
        for k in range(ORDER, -1, -1):
            grams_, n, contexts, total, symbols = self.levels[k]
            if not len(grams_):
                continue
            key = asked & U((1 << 8 * (k + 1)) - 1)
            c = np.minimum(np.searchsorted(contexts, key >> U(8)), len(contexts) - 1)
            known = contexts[c] == key >> U(8)
            g = np.minimum(np.searchsorted(grams_, key), len(grams_) - 1)
            has = open_ & known & (grams_[g] == key)
            rest = total[c] - gone_n
            out[has] += np.log10((2 * n[g[has]] - 1) / (2 * rest[has]))
            escape = open_ & known & ~has & (rest > 0)
            out[escape] += np.log10((symbols[c[escape]] - gone_d[escape]) / (2 * rest[escape]))
            open_ &= ~has
            if k:
                below, m, *_ = self.levels[k - 1]
                held = m[np.searchsorted(below, grams_ & U((1 << 8 * k) - 1))]
                shared = np.add.reduceat(held, _begins(grams_ >> U(8)))
                gone_n, gone_d = np.where(known, shared[c], 0), np.where(known, symbols[c], 0)
        out[open_] -= np.log10(max(1, SYMBOLS - len(self.levels[0][0])))
        return out


def _pack(keys: np.ndarray) -> bytes:
    """Grams of six bytes: the upper halves first, which compress."""
    return (keys >> U(32)).astype("<u2").tobytes() + keys.astype("<u4").tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    return np.frombuffer(blob, "<u2", n).astype(U) << U(32) | np.frombuffer(blob, "<u4", n, 2 * n)


def _group_grams(texts: list[bytes], learn: list[bool], dealt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams of a group by bucket and value, their counts in texts to learn from, and where buckets begin."""
    keys, counts = [], []
    for chunk in _chunked(texts):
        flag = np.repeat([learn[i] for i, *_ in chunk], [len(body) for _, _, body, _ in chunk])
        g = np.sort(grams(chunk) << U(1) | flag.astype(U))
        at = _begins(g)
        n = np.diff(at, append=len(g))
        keys.append(g[at] >> U(1))
        counts.append(np.where(g[at] & U(1), n, 0))
    key, n = _summed(np.concatenate(keys), np.concatenate(counts))
    bucket = dealt[(key >> U(8) & U(0xFFFF)).astype(np.int64)]
    order = np.argsort(bucket, kind="stable")
    return key[order], n[order], np.searchsorted(bucket[order], np.arange(dealt.max() + 2))


def _by_bucket(words: Iterable[bytes], buckets: int) -> list[list[bytes]]:
    """Distinct words by bucket, sorted in each."""
    out = [[] for _ in range(buckets)]
    for w in words:
        out[zlib.crc32(w) % buckets].append(w)
    for ws in out:
        ws.sort()
    return out


class Ids(dict):
    """A number for each new key."""

    def __missing__(self, key: bytes) -> int:
        self[key] = out = len(self)
        return out


def _send(dealt: np.ndarray, buckets: int, fan: int):
    def task(frame: pd.DataFrame) -> pd.DataFrame:
        pid, texts, learn = int(frame["_pid"].iloc[0]), _texts(frame), frame["_learn"].tolist()
        key, n, cuts = _group_grams(texts, learn, dealt)
        part, rows = pid // fan, []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            mine = slice(cuts[b], cuts[b + 1])
            rows.append((0, b, part, pid, _pack(key[mine]), n[mine].astype("<u4").tobytes()))
        learnt, asked = Counter(), set()
        for text, used in zip(texts, learn, strict=True):
            for *_, words in segments(text):
                (learnt if used else asked).update(words)
        for b, words in enumerate(_by_bucket(asked | learnt.keys(), buckets)):
            if words:
                rows.append((1, b, part, pid, b" ".join(words), np.array([learnt[w] for w in words], "<u4").tobytes()))
        return pd.DataFrame(rows, columns=["kind", "bucket", "part", "pid", "keys", "counts"])

    return task


def _sum(width: str):
    """Adds tables up; ``width`` of the counts that come in, 64 bits go out."""

    def task(frame: pd.DataFrame) -> pd.DataFrame:
        kind = int(frame["kind"].iloc[0])
        counts = [np.frombuffer(c, width).astype(np.int64) for c in frame["counts"]]
        if kind == 0:
            key, n = _summed(np.concatenate([_unpack(k) for k in frame["keys"]]), np.concatenate(counts))
            blob = _pack(key)
        else:
            total: dict[bytes, int] = {}
            for keys, more in zip(frame["keys"], counts, strict=True):
                for w, c in zip(bytes(keys).split(b" "), more.tolist(), strict=True):
                    total[w] = total.get(w, 0) + c
            words = sorted(total)
            blob, n = b" ".join(words), np.array([total[w] for w in words])
        return pd.DataFrame([(kind, int(frame["bucket"].iloc[0]), int(frame["part"].min()), blob, n.astype("<i8").tobytes())], columns=["kind", "bucket", "part", "keys", "counts"])

    return task


def _answer(pairs: np.ndarray):
    """Replies to the messages of ``FAN`` groups from the bucket's whole table."""

    def task(messages: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        if not len(messages):
            return pd.DataFrame({c: [] for c in ("kind", "pid", "keys", "answers", "types")})
        kind = int(messages["kind"].iloc[0])
        counts = np.frombuffer(whole["counts"].iloc[0], "<i8")
        rows, first = [], messages["pid"].min()
        if kind == 0:
            key = _unpack(whole["keys"].iloc[0])
            log = Trie(key, counts, pairs).log10(key).astype("<f4")
            reply = lambda blob: log[np.searchsorted(key, _unpack(blob))]
        else:
            place = {w: c for w, c in zip(bytes(whole["keys"].iloc[0]).split(b" "), counts.tolist(), strict=True)}
            reply = lambda blob: np.array([place[w] for w in bytes(blob).split(b" ")], "<i8")
        for pid, blob in zip(messages["pid"], messages["keys"], strict=True):
            # the first group of the first part is told how many distinct words were learnt
            types = int((counts > 0).sum()) if kind and pid == first and messages["part"].iloc[0] == whole["first"].iloc[0] else 0
            rows.append((kind, int(pid), blob, reply(blob).tobytes(), types))
        return pd.DataFrame(rows, columns=["kind", "pid", "keys", "answers", "types"])

    return task


def _looked_up(asked: np.ndarray, key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """``value`` of each gram.  Blocks of 2**16 are sorted with their places in the low bits, so each block meets the sorted keys in order."""
    out = np.empty(len(asked))
    for begin in range(0, len(asked), 1 << 16):
        block = asked[begin : begin + (1 << 16)]
        packed = np.sort(block << U(16) | np.arange(len(block), dtype=U))
        gram = packed >> U(16)
        at = _begins(gram)
        found = value[np.searchsorted(key, gram[at])]
        out[begin + (packed & U(0xFFFF)).astype(np.int64)] = np.repeat(found, np.diff(at, append=len(gram)))
    return out


def _score(frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    texts, learn = _texts(frame), frame["_learn"].tolist()
    (asked, answers), (asked_words, answered) = ([[bytes(x) for x in replies[c][replies["kind"] == kind]] for c in ("keys", "answers")] for kind in (0, 1))
    key, log = np.concatenate([_unpack(x) for x in asked]), np.concatenate([np.frombuffer(x, "<f4") for x in answers]).astype(float)
    order = np.argsort(key)
    key, log = key[order], log[order]
    ids, numbers, owners, sizes, out = Ids(), [], [], [], np.zeros((4, len(texts)))
    for chunk in _chunked(texts):
        begins = np.cumsum([0] + [len(body) for _, _, body, _ in chunk])[:-1]
        sums = np.add.reduceat(_looked_up(grams(chunk), key, log), begins)
        for (i, _, _, words), total in zip(chunk, sums.tolist(), strict=True):
            out[2, i] += total
            numbers.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
            owners.append(i)
            sizes.append(len(words))
    count = np.zeros(len(ids), np.int64)
    count[[ids[w] for blob in asked_words for w in blob.split(b" ")]] = np.frombuffer(b"".join(answered), "<i8")
    numbers, begins = np.concatenate(numbers), np.cumsum([0] + sizes)[:-1]
    for at, each in ((0, np.ones(len(ids))), (1, count > 0), (3, np.log10(count + 0.5))):
        np.add.at(out[at], owners, np.add.reduceat(each.astype(float)[numbers], begins))
    held = frame["_held"].to_numpy()
    tokens = np.where(learn, out[0], 0).astype("int64")
    types = np.zeros(len(texts), "int64")
    types[0] = replies["types"].sum()
    return pd.DataFrame({"doc_id": frame["doc_id"], "held_out": held, "n_tokens": out[0].astype("int64"), "n_known": out[1].astype("int64"), "score": out[2], "base_sum": out[3], "tokens": tokens, "types": types})


def score(docs: DataFrame, group_bytes: int = GROUP_BYTES, fan: int = FAN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; learns from rows that are not held out."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.encode("text", "utf-8").alias("_body"), held_out(F.col("doc_id")).alias("_held")).withColumn("_learn", ~F.col("_held"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("_body"), F.lit(0)) + 1).alias("n")).first()["n"] or 1
    groups = max(1, -(-size // group_bytes))
    counted = rows.filter("_learn").select("_body").mapInPandas(_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = np.zeros(1 << 16, np.int64)
    for r in counted.collect():  # at most 65,536 rows
        pairs[r["pair"]] = r["n"]
    dealt = _dealt(pairs, groups)
    # numbered rows: copies of one row are spread, too
    rows = rows.withColumn("_pid", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)))
    bodies = rows.groupBy("_pid")
    messages = bodies.applyInPandas(_send(dealt, groups, fan), _MESSAGE)
    by = ("kind", "bucket", "part")
    parts = messages.groupBy(*by).applyInPandas(_sum("<u4"), _TABLE)
    whole = parts.groupBy("kind", "bucket").applyInPandas(_sum("<i8"), _TABLE).withColumnRenamed("part", "first")
    sent = whole.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit((groups - 1) // fan))))
    replies = messages.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(_answer(pairs), _REPLY)
    out = bodies.cogroup(replies.groupBy("pid")).applyInPandas(
        _score, "doc_id string, held_out boolean, n_tokens long, n_known long, score double, base_sum double, tokens long, types long"
    )
    out = stored(out)
    total = out.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    n, v = total["n"] or 0, total["v"] or 0
    base = F.col("base_sum") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
