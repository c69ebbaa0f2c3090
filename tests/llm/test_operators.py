"""The operators against brute force on small tables with nulls, ties, repeated rows and long texts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cyclonespark.llm import (
    ann_forest,
    html_template,
    minmax_dedup,
    mixing,
    packing,
    quality_rules,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, link string, _words int, shard int"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _rows():
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("the", "an", "of", "er", "it", "to", "der", "réeux") for b in ("", "ing", "ed", "x1", "ß")]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(300)
    rows = [None, "", " \n\t ", "word", "a b", "x " * 3000, base, base, base + " tail", text(40) + "\n" + passage + "\n" + text(30), passage.upper(), passage + " " + text(200), "Don't stop!!! <|endoftext|> 3²", "日本語 テキスト ééé é", text(4000)]
    for _ in range(40):
        w = base.split()
        for _ in range(rng.randint(1, 25)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary) + str(rng.randint(0, 9))
        rows.append(" ".join(w))
    rows += [text(rng.randint(1, 150)) for _ in range(40)]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None]), None if t is None else len(t), "x", 1, 2) for i, t in enumerate(rows)]
    return [*out, out[8], (None, "no id at all", None, None, 3, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_quality_counts(docs, rows, none):
    def want(t):
        t = t or ""
        w = WORD.findall(t)
        times, covered = collections.Counter(zip(w, w[1:], w[2:], strict=False)), set()
        for i in range(len(w) - 2):
            if times[tuple(w[i : i + 3])] > 1:
                covered |= {i, i + 1, i + 2}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), sum(c in quality_rules.SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered)

    got = quality_rules.score(docs).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((repr(r.doc_id), *(r[c] for c in columns)) for r in got) == sorted((repr(x[0]), *want(x[1])) for x in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert quality_rules.score(none).count() == 0


def test_substring_dedup(docs, rows, none):
    words = [WORD.findall(x[1] or "") for x in rows]
    times = collections.Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = []
    for x, w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if times[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(a for a, g in zip(w, gone, strict=True) if not g)
        want.append((repr(x[0]), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substring_dedup.dedup(docs).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)
    assert sum(r.n_removed > 0 for r in got) > 5
    assert all(hashlib.sha256(" ".join(WORD.findall(r.kept_text)).encode()).hexdigest() == r.kept_sha256 for r in got)
    assert substring_dedup.dedup(none).count() == 0


def _components(rows, k):
    sets = []
    for x in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x[1] or ""))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, x in enumerate(rows):
        if x[0] is not None:
            least[find(i)].append(x[0])
    return [(repr(x[0]), len(sets[i]), min(least[find(i)], default=None)) for i, x in enumerate(rows)]


@pytest.mark.parametrize("k", [2, 5])
def test_near_dups(docs, rows, k):
    got = minmax_dedup.near_dups(docs, k).collect()
    assert sorted(map(repr, ((repr(r.doc_id), r.n_shingles, r.component_id) for r in got))) == sorted(map(repr, _components(rows, k)))
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)


def test_near_dup_hub_with_strays(spark):
    """Copies of one text of which few pairs but many links to the original are similar enough."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(900)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = [(0, " ".join(base))]
    while len(rows) < 160:
        w = list(base)
        for _ in range(rng.randint(2, 16)):
            w[rng.randrange(150)] = rng.choice(vocabulary)
        rows.append((len(rows), " ".join(w)))
        if rng.random() < 0.2:
            w[rng.randrange(150)] = "again"
            rows.append((len(rows), " ".join(w)))
    got = minmax_dedup.near_dups(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, r.component_id) for r in got) == sorted(_components(rows, 2))


def test_near_dedup_keeps_one_of_each_group(docs, rows, none):
    got = minmax_dedup.dedup(docs).collect()
    want = {c for _, _, c in _components(rows, 5) if c is not None}
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(want)
    assert minmax_dedup.dedup(none).count() == 0


def test_near_dedup_keeps_texts_with_null_or_shared_ids(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    alone = [(None, text(30)) for _ in range(6)]
    shared = [(7, text(30)), (7, text(30)), (7, ""), (8, " \n"), (8, " \n")]
    pair, many = text(200), text(200)
    rows = [*alone, *shared, (None, ""), (None, ""), (None, None), (None, pair), (None, pair + " x"), (None, many), (3, many + " y"), (5, many + " z")]
    got = minmax_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len([r for r in got if r.text in (pair, pair + " x")]) == 1
    want = [*alone, *shared[:-1], (None, ""), (None, ""), (None, None), (3, many + " y")]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got if r.text not in (pair, pair + " x")))) == sorted(map(repr, want))


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = collections.defaultdict(list)
    for x in rows:
        ids[x[0]].append([*tokenizer.encode(x[1] or "", add_special_tokens=False).ids, 2])
    got = packing.pack(docs, TOKENIZER).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        of = ids[r.doc_id][0]
        assert r.doc_tokens == len(of)
        assert r.ids_crc32 == zlib.crc32(np.asarray(of[r.start : r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, whole in ids.items():
        covered = sorted(i for s, n in pieces[doc_id] for i in range(s, s + n))
        assert covered == sorted([*range(len(whole[0]))] * len(whole))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096 and at & (at - 1) == 0
    assert packing.pack(none, TOKENIZER).count() == 0


def test_packing_ids_are_the_tokenizers(monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(5)
    pool = ["'", "'", "s", "T", "re", "ve", "m", "LL", "d", "l", "!", "3", "²", " ", "\n", "\t", "é", "ß", "\xa0", "\x85", "\x1c", "\0", "’", "e\u0301", "İ", "日本", "<|", "<|endoftext|>"]
    texts = [chr(a) + chr(b) for a in range(256) for b in range(0, 256, 7)] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    want = [np.asarray(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert packing.WordIds(TOKENIZER)(texts) == want
    monkeypatch.setattr(packing, "MEMO", 50)  # forgets all the time
    small = packing.WordIds(TOKENIZER)
    assert [b for i, j in packing.slices(texts, 300) for b in small(texts[i:j])] == want
    assert small([]) == [] and small(["", " \n"]) == [b"", b""]


def test_packing_cuts_texts_in_bulk():
    import cProfile
    import pstats

    words = ["".join(random.Random(i).choices("abcdeé", k=9)) for i in range(20000)]
    texts = [" ".join(words[i : i + 100]) + "." for i in range(0, len(words), 100)]
    encode = packing.WordIds(TOKENIZER)
    with cProfile.Profile() as profile:
        ids = encode(texts)
    assert len(ids) == len(texts) and pstats.Stats(profile).total_calls < len(words)  # no calls for each word


def test_token_counts(docs, rows, none):
    vocabulary = set(token_counts.vocabulary(TOKENIZER))
    longest = max(map(len, vocabulary))

    def pieces(word):
        s, i, n = (*word.encode(), token_counts.END), 0, 0
        while i < len(s):
            i = next((j for j in range(min(len(s), i + longest), i, -1) if s[i:j] in vocabulary), i + 1)
            n += 1
        return n

    got = token_counts.count_tokens(docs, TOKENIZER).collect()
    want = [(repr(x[0]), len(WORD.findall(x[1] or "")), sum(map(pieces, WORD.findall((x[1] or "").lower())))) for x in rows]
    assert sorted((repr(r.doc_id), r.n_words, r.n_tokens) for r in got) == sorted(want)
    assert token_counts.count_tokens(none, TOKENIZER).count() == 0


def test_longest_match_without_single_symbols():
    matcher = token_counts.LongestMatch([(97, 98, 99), (97,), (98,), (token_counts.END,)])
    assert matcher.count(b"abcab") == 4  # abc a b end
    assert matcher.count(b"zz") == 3  # two unknown symbols and the end


def test_sharding(docs, rows, none):
    got = sharding.shard(docs, 4).collect()
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((repr(x[0]), len((x[1] or "").encode()) + 1, zlib.crc32((x[1] or "").encode())) for x in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) <= {0, 1, 2, 3} and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.cut_links(spark_frame(docs, got)).filter("shards > 1").count() == 0
    assert sharding.shard(none, 4).count() == 0


def spark_frame(like, got):
    return like.sparkSession.createDataFrame([(r.link, r.shard) for r in got], "link string, shard int")


def test_sharding_splits_a_hot_group(spark):
    rows = [(i, "same") for i in range(400)] + [(i, f"t{i // 2}") for i in range(400, 1000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [250] * 4
    cut = sharding.cut_links(got)
    assert cut.filter("rows = 2 AND shards > 1").count() <= 150  # of 300, where every shard is full; 225 at random
    if cut.filter("rows = 400").first().shards > 3:
        pytest.xfail("known fault: where every shard is full, remains of a large group stay behind")


def test_mixing(docs, rows, none):
    out = mixing.mix(docs)
    got = out.select("doc_id", "text", "_topic", "_tokens", "_p", "_kept").collect()
    assert len(got) == len(rows) and all(r._tokens == len(WORD.findall(r.text or "")) and 0 <= r._p <= 1 for r in got)
    assert mixing.mix(none).count() == 0


def test_raking_meets_the_marginals(spark):
    cells = spark.createDataFrame([(s, g, t, 10 * (i + 1) ** 2) for i, (s, g, t) in enumerate((s, g, t) for s in "abc" for g in "xy" for t in "pq")], "source string, lang string, topic string, tokens long")
    got = mixing.rake(cells, rounds=30).toPandas()
    for margin in mixing.MARGINS:
        tokens, weight = got.groupby(margin)["tokens"].sum(), got.groupby(margin)["weight"].sum()
        target = tokens**mixing.TEMPER / (tokens**mixing.TEMPER).sum() * tokens.sum()
        assert np.allclose(weight, target, rtol=1e-6)


@pytest.mark.parametrize("targets", [None, {"source": {"hot": 0.3, "s1": 0.4}, "topic": {"legal": 0.2}}])
def test_drawn_sample_meets_the_targets(spark, targets):
    """Token shares of the drawn documents beside a hot source, whose small fellows would need p far above 1."""
    rng = random.Random(8)
    marks = ["", "", "", "", "", "", "", "Copyright", "a@b", "x | y"]
    rows = [(i, f"{'w ' * rng.randint(5, 15)}{rng.choice(marks)}", rng.choice(["en", "en", "en", "de"]), rng.choice(["hot"] * 18 + ["s1", "s2"])) for i in range(30000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    drawn = mixing.mix(frame, targets=targets, bounded=True).select("source", "lang", F.col("_topic").alias("topic"), "_tokens", "_p", "_kept").toPandas()
    assert drawn["_p"].between(0, 1).all() and drawn["_kept"].mean() > 0.05
    for margin in mixing.MARGINS:
        tokens = drawn.groupby(margin)["_tokens"].sum() ** mixing.TEMPER
        want = dict(tokens / tokens.sum())
        if given := (targets or {}).get(margin):
            rest = sum(v for g, v in want.items() if g not in given)
            want = {g: given.get(g, v / rest * (1 - sum(given.values()))) for g, v in want.items()}
        expected = (drawn["_tokens"] * drawn["_p"]).groupby(drawn[margin]).sum()
        got = drawn[drawn["_kept"]].groupby(margin)["_tokens"].sum()
        for g, share in want.items():
            assert abs(expected[g] / expected.sum() - share) <= 0.01 * share
            assert abs(got[g] / got.sum() - share) <= 0.1 * share


def test_toxicity_learns_and_handles_edges(spark, none):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        bad = rng.random() < 0.3
        w = [rng.choice(words) for _ in range(rng.randint(3, 60))] + ([rng.choice(["scumbag", "moron"])] if bad else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows += [(700, None), (701, ""), (None, "moron")]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (700, None)], "doc_id long, label int")
    machine = toxicity.fit(docs, marks.filter(~toxicity.held_out(F.col("doc_id"))))
    got = {r.doc_id: r for r in toxicity.score(docs, machine).collect()}
    truth = dict(labels)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.97
    assert 0 <= got[700].score <= 1 and got[700].score == got[701].score and got[None].predicted == 1
    assert toxicity.score(none, machine).count() == 0
    one_label = toxicity.fit(docs, marks.filter("label = 0"))
    assert all(r.score < 0.5 for r in toxicity.score(docs, one_label).collect())


def test_toxicity_learns_pairs_of_words_harmless_alone(spark):
    rng = random.Random(2)
    filler = [f"word{i}" for i in range(400)]
    rows, truth = [], {}
    for i in range(4000):
        one, two = rng.random() < 0.5, rng.random() < 0.5
        w = rng.sample(filler, 20) + ["crimson"] * one + ["lantern"] * two
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        truth[i] = int(one == two)  # neither word says anything without the other
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(truth.items()), "doc_id long, label int")
    machine = toxicity.fit(docs, marks.filter(~toxicity.held_out(F.col("doc_id"))))
    held = docs.filter(toxicity.held_out(F.col("doc_id")))
    assert np.mean([r.predicted == truth[r.doc_id] for r in toxicity.score(held, machine).collect()]) > 0.9


def test_forest_recall_and_edges(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)).astype("float32")
    x[100:400] = x[100]  # a vector that many rows share
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(1500, None, 0), (1520, [0.0] * 16, 0), (1540, [float("nan")] * 16, 0), (1560, [1.0, None] * 8, 0), (1580, [1.0, 2.0], 0), (None, x[0].tolist(), 0), rows[20]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(3)
    ok = F.col("vec_id") % 20 == 0
    got = ann_forest.search(frame, ok, candidates=9000, trees=8).toPandas()
    assert not set(got["query_id"]) & {1500, 1520, 1540, 1560, 1580}
    big = x.astype(float)
    recall = []
    for q, found in got.groupby("query_id"):
        s = big @ big[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(s)), -s))[:20]
        found = found.sort_values("rank")
        assert found["rank"].tolist() == list(range(1, 21)) and np.allclose(found["score"], s[found["vec_id"]], rtol=0, atol=1e-12)
        recall.append(len(set(best) & set(found["vec_id"])) / 20)
    assert len(recall) == 75 and np.mean(recall) >= 0.9
    few = ann_forest.search(frame.filter("vec_id < 5 OR vec_id = 20"), ok).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(0, i) for i in range(1, 6)] + [(20, i) for i in range(1, 6)]
    assert ann_forest.search(frame.filter("vec_id < 0"), ok).count() == 0


def test_forest_candidates_follow_the_table(spark):
    """Recall holds on a table that has many times the least number of candidates."""
    x = np.random.default_rng(6).normal(size=(6000, 32))
    x /= np.sqrt((x**2).sum(1))[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann_forest.search(frame, F.col("vec_id") % 100 == 0, candidates=600).toPandas()
    recall = []
    for q, found in got.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        recall.append(len(set(np.argsort(-s)[:20]) & set(found["vec_id"])) / 20)
    assert len(recall) == 60 and np.mean(recall) >= 0.9
    one = ann_forest.search(frame, F.col("vec_id") == 5, candidates=600)  # most blocks have no query
    assert sorted(r["rank"] for r in one.collect()) == list(range(1, 21))


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li>Menu {i}</li></ul></nav>'
    '<div class="ad">Buy {i}</div><article><h1>Title &amp; {i}</h1><p>One  <b>bold</b>\n text{i}<p>Two&nbsp;{i}</p></article><div id="comments">me too {i}</div><footer>&copy; x</footer></body></html>'
)


def test_html(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", PAGE.format(i=i)) for i in range(8)]
    plain = "<div><p>Site of all</p><p>Body {i}</p></div>"
    rows += [(20 + i, f"http://plain.example/{i}", plain.format(i=i)) for i in range(4)]
    rows += [(30, None, None), (31, "http://h0.example/x", ""), (32, "x", "no markup &lt;here&gt;"), rows[0], (None, "http://h0.example/y", PAGE.format(i=9))]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int").repartition(3)
    got = {r.page_id: r for r in html_template.extract(frame).collect()}
    assert got[3].text == "Title & 3\n\nOne bold text3\n\nTwo 3" and got[3].n_chars == len(got[3].text)
    assert got[21].text == "Body 1"  # a text of all the host's pages is its template's
    assert got[30].text == got[31].text == "" and got[32].text == "no markup <here>"
    assert html_template.extract(frame).count() == len(rows)
    assert html_template.extract(frame.filter("page_id < 0")).count() == 0


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ('<p>One <svg viewBox="0 0 1 1"/> two</p><p>Three</p>', "One two\n\nThree"),
        ("<p>One<svg-icon></svg-icon> two</p><object-card><p>Three</p></object-card><template-x><p>Four</p></template-x>", "One two\n\nThree\n\nFour"),
        ("<p>One</p><object data=x><p>Two</p><canvas><p>Three</p>", "One\n\nTwo\n\nThree"),
        ("<p>One</p><object>a<object>b</object>c</object><p>Two</p><svg><title>t</title><svg>u</svg>v</svg><p>Three</p>", "One\n\nTwo\n\nThree"),
        ('<p>One</p><script>var a = "<svg>";</script><!-- <object> --><p>Two</p><svg>t</svg><p>Three</p><style>b', "One\n\nTwo\n\nThree"),
    ],
)
def test_html_skips_raw_elements_only(body, text):
    assert html_template.main_text(f"<html><body><article>{body}", html_template._NONE) == text


def test_pipeline_stages_follow_their_operators(spark, docs):
    import corpus_pipeline as pipeline

    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "mixing", "packing"]
    kept = docs.select(*pipeline.COLUMNS)
    before = kept.count()
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, kept, "").cache()
        assert kept.columns == list(pipeline.COLUMNS) and kept.count() <= before
        before = kept.count()
    packed = pipeline.STAGES[-1][1](spark, kept, "")
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}


def test_html_lost_end_tag_is_where_the_template_has_it(spark):
    def page(i, end="</div>"):
        return (f'<html><body><div class="page"><div class="sidebar"><ul><li>Link {i}</li></ul>{end}'
                f'<div class="text"><section><p>Story {i} is told here.</p></section></div></div></body></html>')

    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(30)]
    rows += [(30, "http://a.example/30", page(30, "")), (31, "http://a.example/31", page(31)[:130]), (32, "http://one.example/", page(32, ""))]
    got = {r.page_id: r.text for r in html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i} is told here." for i in range(31))  # 30: the sidebar does not swallow the story


def _neutral_pages():
    """Pages whose classes say nothing: a menu and a box of other stories, both different on each page, beside the story."""
    rows = []
    for i in range(8):
        menu = "".join(f'<li><a href="/{i}/{k}">Section {i * 7 + k}</a></li>' for k in range(3))
        other = "".join(f'<p><a href="/s{k}">Another story numbered {i * 5 + k}</a></p>' for k in range(2))
        source = f'<p>Sources are <a href="/q{i}">report {i}</a>.</p>' if i % 2 else ""
        rows.append((i, "http://h.example.org/", f'<html><body><div class="q1"><ul>{menu}</ul></div><div class="q2"><h1>Title {i}</h1><p>Text of story {i}, told at length.</p>{source}</div><div class="q3">{other}</div></body></html>'))
    rows.append((8, "http://links.example.org/", rows[0][2]))  # a host of one page has no slots to tell
    return rows


def test_html_slots_of_links_are_left_out_by_the_template(spark, monkeypatch):
    rows = _neutral_pages()
    got = {r.page_id: r.text for r in html_template.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == f"Title {i}\n\nText of story {i}, told at length." + (f"\n\nSources are report {i}." if i % 2 else "")
    assert "Section 0" in got[8] and "Another story numbered 1" in got[8]
    # the classes decide: with no valid element, and with links alone, all stays
    role = html_template.Page(rows[0][2]).tokens
    numbers = np.array(sorted({t[3] for t in role if t[0] != "text"}))
    host = html_template.Template(8, numbers, np.ones(len(numbers)), np.full(len(numbers), 8))
    assert "Section 0" not in html_template.main_text(rows[0][2], host)
    monkeypatch.setattr(html_template.Template, "valid", lambda *_: False)
    assert "Section 0" in html_template.main_text(rows[0][2], host)
    monkeypatch.undo()
    links = '<html><body><div class="q1"><ul><li><a href="/">Section 0</a></li></ul></div></body></html>'
    assert html_template.main_text(links, host) == "Section 0"
