"""Packing: hierarchical multi-length packing of tokenised documents.

A document's ids are its tokens and an end id.  Full windows of the longest tier are cut
off first; what remains is routed to the shortest context tier that holds it.  Each tier
is packed longest first; gaps of a window are filled from the shorter tiers, longest
fitting remainder first, and the last few ids of a gap by a piece cut from a document,
whose other part is routed anew.  What is left at the end is laid out in windows of
falling powers of two, so every sequence is a power of two long and none needs padding.

One Spark task packs its own rows, block by block (``BLOCK_IDS`` ids), so the work needs
no shuffle, memory is bounded by a block and a lost task is run again alone; the price is
a dozen windows shorter than the tiers a block.  Sequences of a block are dealt to step groups of equal
token budget.

Nulls and edge cases: a null text is empty, and an empty text is the end id alone; repeated rows are
packed as rows of their own; an empty table gives no rows; columns but doc_id and text
are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import groupby, pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import lean, ship

TIERS = (256, 512, 1024, 2048, 4096)
END_ID = 2
#: ids that a task holds before it packs them
BLOCK_IDS = 4_000_000
#: ids of one step group
STEP_IDS = 64 * 4096
#: remembered word parts of a Python worker, and as many words that are not Latin-1
MEMO = 800_000
#: characters that a Python worker cuts into parts at once
SLICE = 2_000_000
_FOREIGN = re.compile("[^\0-\xff]")

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

_BLANK, _LETTER, _DIGIT, _OTHER = range(4)
#: lower case and kind of each Latin-1 character, as the tokenizer's own rules have them
_LOWER = "".join(map(chr, range(256))).lower().encode("latin-1")
_KIND = bytes(
    _BLANK if re.match("[\t-\r \x85\xa0]", c) else _LETTER if re.match("[A-Za-zªµºÀ-ÖØ-öø-ÿ]", c) else _DIGIT if re.match("[0-9²³¹¼-¾]", c) else _OTHER
    for c in map(chr, range(256))
)


def cut_parts(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """Where the tokenizer's own pre-tokens begin in Latin-1 text, and the pre-tokens in lower case, in order.

    They are 's, 't, 're, 've, 'm, 'll and 'd, runs of letters, single digits and runs of what else is not blank.
    ``data`` begins and ends with three blanks.
    """
    low = data.translate(_LOWER)
    chars, kind = np.frombuffer(low, np.uint8), np.frombuffer(data.translate(_KIND), np.uint8)
    begins = kind == _DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    quotes = np.flatnonzero(chars == ord("'"))
    quotes = quotes[kind[quotes - 1] != _OTHER]  # others are inside a run
    second, third = chars[quotes + 1], chars[quotes + 2]
    short = np.isin(second, list(b"stmd"))
    long = (np.isin(second, list(b"rv")) & (third == ord("e"))) | ((second == ord("l")) & (third == ord("l")))
    begins[quotes[short | long] + 1] = False
    begins[quotes[short] + 2] = True
    begins[quotes[long] + 3] = True
    solid = kind != _BLANK
    begins &= solid
    body = chars[solid]
    offsets = np.append(np.flatnonzero(begins[solid]), len(body)).astype("int32")
    parts = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return np.flatnonzero(begins), parts


class WordIds:
    """Ids of a text, part by part, with a memory of parts.

    The tokenizer drops white space and no token crosses it or a pre-token's end, so a text's
    ids are those of its pre-tokens, of which far fewer differ.  Latin-1 texts are cut many at
    a time, and only pre-tokens not yet known go to the tokenizer; words with other characters
    go there as they are, and a text with a special token's mark goes there whole.
    """

    def __init__(self, path: str):
        # one call encodes one text, so threads would only add to the executor's own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same model for pre-tokens in lower case between blanks
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        last = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(last.values()) + 1, bool)
        for token, i in last.items():
            self.ends[i] = token.endswith("</w>")
        self.words: dict[str, bytes] = {}
        self.parts: dict[bytes, int] = {}  # the part's first place in ``ids``, times 2 ** 32, and its number of ids
        self.ids = array("H")

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _word(self, word: str) -> bytes:
        if word not in self.words:
            if len(self.words) >= MEMO:
                self.words = {}
            self.words[word] = self._whole(word)
        return self.words[word]

    def _learn(self, parts: list[bytes]) -> list[int]:
        """Encode pre-tokens as one text; each ends with a token that ends a word."""
        ids = np.asarray(self.plain.encode_batch_fast([b" ".join(parts).decode("latin-1")], add_special_tokens=False)[0].ids, "<u2")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(parts):  # a part that is not one pre-token of its own
            each = [np.frombuffer(self._whole(p.decode("latin-1")), "<u2") for p in parts]
            ids, cuts = np.concatenate(each), np.cumsum([len(e) for e in each])
        sizes = np.diff(cuts, prepend=0)
        places = (((len(self.ids) + cuts - sizes) << 32) | sizes).tolist()
        self.ids.frombytes(ids.tobytes())
        self.parts.update(zip(parts, places, strict=True))
        return places

    def _places(self, parts: list[bytes]) -> np.ndarray:
        """Places of distinct parts, those of unknown ones after learning them."""
        places = np.fromiter(map(self.parts.get, parts, repeat(-1)), "int64", len(parts))
        new = np.flatnonzero(places < 0)
        if len(self.parts) + len(new) > MEMO or len(self.ids) > 8 * MEMO:
            self.parts, self.ids = {}, array("H")
            new = np.arange(len(parts))
        for i in range(0, len(new), 5000):
            some = new[i : i + 5000]
            places[some] = self._learn([parts[j] for j in some.tolist()])
        return places

    def _latin(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 16-bit ids of Latin-1 texts."""
        begins, parts = cut_parts(b"   " + b" ".join(texts) + b"   ")
        coded = parts.dictionary_encode()
        places = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        sizes = places & 0xFFFFFFFF
        ends = np.cumsum(sizes)
        at = np.repeat((places >> 32) - (ends - sizes), sizes) + np.arange(sizes.sum())
        ids = np.frombuffer(self.ids, np.uint16)[at].astype("<u2").tobytes() if len(at) else b""
        # a text's parts are those that begin before the next text
        nexts = np.searchsorted(begins, np.cumsum([len(t) + 1 for t in texts]) + 2)
        cuts = [0, *(2 * np.append(0, ends)[nexts]).tolist()]
        return [ids[a:b] for a, b in pairwise(cuts)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each text."""
        latin: list[bytes] = []
        made: list[list[bytes | int]] = []  # by text: ids, or a place in ``latin``
        for t in texts:
            if "<|" in t:
                made.append([self._whole(t)])
                continue
            try:
                latin.append(t.encode("latin-1"))
                made.append([len(latin) - 1])
            except UnicodeEncodeError:
                own: list[bytes | int] = []
                for foreign, ws in groupby(t.replace("\n", " ").split(" "), lambda w: _FOREIGN.search(w) is not None):
                    if foreign:
                        own += map(self._word, ws)
                    else:
                        own.append(len(latin))
                        latin.append(" ".join(ws).encode("latin-1"))
                made.append(own)
        ids = self._latin(latin) if latin else []
        return [b"".join([ids[x] if isinstance(x, int) else x for x in own]) for own in made]


def slices(texts: list[str], chars: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of texts, from and up to, of about ``chars`` characters (``SLICE``) or one text."""
    begin = size = 0
    for i, t in enumerate(texts, 1):
        size += len(t)
        if size >= (chars or SLICE) or i == len(texts):
            yield begin, i
            begin, size = i, 0


def plan(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, int, int, int, int]]:
    """Lay documents of these lengths out: (document, start, length, window, offset), with windows from 0.

    Tiers are powers of two.  No window is longer than the longest tier, and every window
    is exactly a tier or, at the end, a power of two long.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    window = 0
    longest = tiers[-1]
    routed: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # by tier: (length, document, start), ascending

    def route(length: int, doc: int, start: int) -> None:
        insort(routed[next(i for i, t in enumerate(tiers) if length <= t)], (length, doc, start))

    rests = []
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= longest:
            pieces.append((doc, start, longest, window, 0))
            window, start = window + 1, start + longest
        if n > start:
            rests.append((n - start, doc, start))
    rests.sort()
    for r in rests:
        routed[next(i for i, t in enumerate(tiers) if r[0] <= t)].append(r)

    def fitting(gap: int, top: int) -> tuple[int, int, int] | None:
        """Take the longest remainder of at most ``gap`` ids from tier ``top`` or a shorter one."""
        for i in range(top, -1, -1):
            if routed[i] and routed[i][0][0] <= gap:
                return routed[i].pop(bisect_right(routed[i], (gap, 1 << 62, 0)) - 1)
        return None

    left = sum(r[0] for r in rests)
    for top in range(len(tiers) - 1, -1, -1):
        size = tiers[top]
        while routed[top] and left >= size:
            # full windows of this tier, each begun by its longest remainder
            gap, parts = size, []
            while gap:
                got = fitting(gap, top)
                if got is None:  # nothing fits whole: cut the shortest one that is there
                    i = next(i for i in range(len(tiers)) if routed[i])
                    length, doc, start = routed[i].pop(0)
                    route(length - gap, doc, start + gap)
                    got = (gap, doc, start)
                parts.append(got)
                gap -= got[0]
            offset = 0
            for length, doc, start in parts:
                pieces.append((doc, start, length, window, offset))
                offset += length
            window, left = window + 1, left - size
    # fewer ids than the longest tier are left: windows of falling powers of two
    rest = sorted((r for tier in routed for r in tier), key=lambda r: (-r[0], r[1]))
    size, room = 0, 0
    for length, doc, start in rest:
        while length:
            if not room:
                size = room = 1 << (left.bit_length() - 1)
                offset = 0
            take = min(room, length)
            pieces.append((doc, start, take, window, offset))
            offset, start, length, room, left = offset + take, start + take, length - take, room - take, left - take
            if not room:
                window += 1
    return pieces


def pack_block(doc_ids: list, ids: list[bytes], first: int, tiers: tuple[int, ...]) -> pd.DataFrame:
    """Pack documents given as 16-bit ids with the end id; sequences are numbered from ``first``."""
    lengths = [len(b) // 2 for b in ids]
    laid = pd.DataFrame(plan(lengths, tiers), columns=["doc", "start", "length", "window", "offset"]).astype("int64")
    crc = []
    for d, s, n in zip(laid["doc"].tolist(), laid["start"].tolist(), laid["length"].tolist(), strict=True):
        crc.append(zlib.crc32(np.frombuffer(ids[d], "<u2", n, 2 * s).astype("<u4").tobytes()))
    filled = laid.groupby("window")["length"].transform("sum")
    # step groups: runs of sequences of equal token budget
    per_window = laid.groupby("window")["length"].sum().sort_index()
    step = ((per_window.cumsum() - per_window) // STEP_IDS).reindex(laid["window"]).to_numpy()
    return pd.DataFrame({
        "doc_id": pd.array([doc_ids[d] for d in laid["doc"].tolist()], dtype="Int64"),
        "start": laid["start"], "length": laid["length"], "ids_crc32": np.asarray(crc, "int64"),
        "doc_tokens": np.asarray(lengths, "int64")[laid["doc"].to_numpy()] if len(laid) else laid["doc"],
        "sequence_id": laid["window"] + first, "offset": laid["offset"],
        "tier": np.asarray([t for t in tiers])[np.searchsorted(tiers, filled.to_numpy())].astype("int32") if len(laid) else laid["doc"].astype("int32"),
        "step_group": step + first,
    })


_ENCODERS: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """The Python worker's own encoder, with what it remembers from earlier tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, doc_id: str = "doc_id", text: str = "text", remember: bool = True) -> DataFrame:
    """Pieces of all documents, in the columns of ``SCHEMA``; sequence ids are unique and a block's are consecutive.

    ``tokenizer_path`` is a file of the tokenizers library on every executor; ids are below 65,536.
    With ``remember`` a Python worker's encoder and its words outlive the task, at up to some 300 MB; without,
    later stages have that memory.
    """
    end = array("H", [END_ID]).tobytes()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path) if remember else WordIds(tokenizer_path)
        # 2 ** 32 sequences a task
        first = TaskContext.get().partitionId() << 32
        names: list = []
        ids: list[bytes] = []
        held = 0
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            keys = [None if pd.isna(k) else int(k) for k in batch["doc_id"]]
            for begin, upto in slices(texts):
                for i, b in enumerate(encode(texts[begin:upto]), begin):
                    names.append(keys[i])
                    ids.append(b + end)
                    held += len(b) // 2 + 1
                    # a block ends with 256 rows or their batch
                    if held >= BLOCK_IDS and ((i + 1) % 256 == 0 or i + 1 == len(texts)):
                        out = pack_block(names, ids, first, tiers)
                        first = int(out["sequence_id"].max()) + 1
                        yield out
                        names, ids, held = [], [], 0
        if ids:
            yield pack_block(names, ids, first, tiers)

    ship(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(task if remember else lean(task), SCHEMA)
