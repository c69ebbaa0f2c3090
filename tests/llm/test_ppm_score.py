"""PPM against a plain trie of dictionaries; base scores against counters."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from cyclonespark.llm import ppm_score as P

SCHEMA = "doc_id long, text string, kind int, bucket int, part int, pid long, keys string, _pid int, _body string, types int"
ORDER = P.ORDER


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def symbols(t):
    body = " ".join(words(t)).encode() + b"\n"
    framed = b"\n" * ORDER + body
    return [(framed[i : i + ORDER], framed[i + ORDER]) for i in range(len(body))]


def trie(texts):
    out = collections.defaultdict(collections.Counter)
    for t in texts:
        for context, s in symbols(t):
            for k in range(ORDER + 1):
                out[context[ORDER - k :]][s] += 1
    return out


def log10(tree, context, s):
    total, excluded = 0.0, set()
    for k in range(ORDER, -1, -1):
        seen = tree.get(context[ORDER - k :])
        if not seen:
            continue
        left = {x: c for x, c in seen.items() if x not in excluded}
        mass = sum(left.values())
        if s in left:
            return total + math.log10((2 * left[s] - 1) / (2 * mass))
        if mass:
            total += math.log10(len(left) / (2 * mass))
        excluded = set(seen)
    return total - math.log10(P.SYMBOLS - len(excluded))


def want(rows):
    learn = [t for i, t in rows if not held(i)]
    tree, count = trie(learn), collections.Counter()
    for t in learn:
        count.update([*words(t), "\n"])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        tokens = [*words(t), "\n"]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((i, held(i), len(tokens), sum(count[w] > 0 for w in tokens), n, base, sum(log10(tree, *x) for x in symbols(t))))
    return out


def same(got, expected):
    key = lambda r: (repr(r[0]), r[2], r[-1])
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    np.testing.assert_allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)
    np.testing.assert_allclose([r[6] for r in got], [r[6] for r in expected], rtol=1e-6)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("the", "An", "of", "er", "réeux", "日本", "\x00") for b in ("", "ing", "ed", "x1", "ß", "TION")]
    text = lambda n: rng.choice([" ", "\n", " \t"]).join(rng.choice(vocabulary) for _ in range(n))
    texts = [None, "", " \n\x0b ", "word", "a b", "x" * 4000, text(5000)] + [text(rng.randint(1, 120)) for _ in range(150)]
    out = list(enumerate(texts))
    return out + [out[9]] * 4 + [(None, "no id " + text(9)), (None, None), (2**60 + 1, "far id")]


@pytest.mark.parametrize(("group_bytes", "fan"), [(10**7, 64), (3_000, 2)])
def test_scores(spark, rows, group_bytes, fan):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, "k", 5, "b", 6) for r in rows], SCHEMA).repartition(3)
    got = P.score(docs, group_bytes, fan)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(got.collect(), want(rows))


def test_a_context_is_a_distribution(rows):
    learn = [(t or "").encode() for i, t in rows if not held(i)]
    key, n, _ = P._group_grams(learn, [True] * len(learn), np.zeros(1 << 16, np.int32))
    pairs = np.zeros(1 << 16, np.int64)
    for t in learn:
        for context, s in symbols(t.decode()):
            pairs[context[-1] << 8 | s] += 1
    order = np.argsort(key)
    model = P.Trie(key[order], n[order], pairs)
    alphabet = [s for s in range(256) if s not in (9, 11, 12, 13)]
    for context in (b"\n\n\n\n\n", b"\n\nthe", b" then", b"zzzzz", b"tion ", "é日".encode()):
        asked = np.array([int.from_bytes(context + bytes([s]), "big") for s in alphabet], np.uint64)
        assert abs((10 ** model.log10(asked)).sum() - 1) < 1e-9


def test_pieces_of_a_long_text_keep_their_contexts(monkeypatch):
    text = b" \n".join([b"Some words", b"w" * 70, b"and  more", b""] * 20)
    whole = list(P.segments(text))
    assert len(whole) == 1
    monkeypatch.setattr(P, "PIECE", 23)
    cut = list(P.segments(text))
    assert len(cut) > 10 and [w for *_, ws in cut for w in ws] == whole[0][2] and b"".join(b for _, b, _ in cut) == whole[0][1]
    number = lambda parts: P.grams([(0, *x) for x in parts]).tolist()
    assert number(cut) == number(whole)


def test_bits_a_byte_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    got = P.score(docs).filter("held_out").collect()
    size = sum(len(symbols(texts[r.doc_id])) for r in got)
    assert len(got) > 100 and -sum(r.score for r in got) / math.log10(2) / size < 2.3


def test_no_rows_and_nothing_to_learn(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert P.score(none).count() == 0
    alone = next(i for i in range(100) if held(i))
    same(P.score(spark.createDataFrame([(alone, "Ab c")], "doc_id long, text string")).collect(), want([(alone, "Ab c")]))
