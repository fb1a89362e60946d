"""Quality rules, decontamination, language-model scores and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pricebeam.llm import bilinear, decontaminate, quality
from pricebeam.llm.bilinear import Model, Vocabulary, score_texts
from pricebeam.llm.decontaminate import overlaps, with_overlaps, without_overlaps
from pricebeam.llm.pieces import Pieces
from test_dedup import covered, plain_fingerprint, plain_groups, windows_of

SF_DIR = "/root/testdata/sf0.001"


def plain_measures(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeat), "n_lines": len(lines),
            "n_capitals": sum("A" <= c <= "Z" for c in text or ""), "n_exclaims": (text or "").count("!")}


def test_measures(texts):
    more = texts.union(texts.sparkSession.createDataFrame(
        [(50, "a b c a b c"), (51, "a a a a"), (52, "x\u000bx\u000cx x x"), (53, "a b c\n\nq\n \nq"), (54, "p q r s t p q r z q r s")],
        "doc_id long, text string"))
    for x in quality.measured(more).collect():
        assert {k: x[k] for k in quality.MEASURES} == plain_measures(x.text)


def test_quality_reads_no_python(documents):
    plan = quality.judged(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)



def test_host_verdicts_tighten_the_limits(spark):
    """7 symbols on 100 words are under the usual limit and over the strict one."""
    clean, mild, bad = (" ".join(f"w{i}{mark if i % step == 0 else ''}" for i in range(100))
                        for mark, step in (("", 1), ("#", 14), ("###", 2)))
    rows = [(i, "bad", f"{bad} {i}") for i in range(30)] + [(100, "bad", mild), (101, "bad", clean)]
    rows += [(200 + i, "good", f"{clean} {i}") for i in range(300)] + [(600, "good", mild), (601, None, clean), (602, "small", bad)]
    got = {x.doc_id: x for x in quality.judged(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert len(got) == len(rows)
    assert not any(got[i].kept for i in range(30))
    assert got[100].suspect_host and not got[100].kept and got[101].kept
    assert got[600].kept and got[601].kept and not got[602].kept
    assert not got[600].suspect_host


def test_small_hosts_are_not_judged_alone(spark):
    rows = spark.createDataFrame([("one", 1.0)] + [(f"h{i % 40}", float(i % 50 == 0)) for i in range(4000)], "host string, bad double")
    rows = rows.select("host", *[F.lit(0).cast("long").alias(c) for c in quality.MEASURES if c not in ("n_symbols", "n_words")],
                       F.lit(100).cast("long").alias("n_words"), (F.col("bad") * 50).cast("long").alias("n_symbols"))
    verdict = {x.host: x for x in quality.host_verdicts(rows).collect()}
    assert verdict["one"].symbols_rate < 0.25 and not verdict["one"].symbols_suspect


def test_quality_odd(odd, nothing):
    got = quality.judged(odd)
    assert got.count() == odd.count()
    assert set(odd.columns) <= set(got.columns)
    assert quality.judged(nothing).collect() == []


def tokens(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_overlaps(docs, items, least=12):
    found = {}
    for d, text in docs:
        words = tokens(text)
        places = defaultdict(list)
        for k, w in enumerate(words):
            places[w].append(k)
        for i, item in items:
            own = tokens(item)
            need = min(least, len(own))
            shifts = Counter(k - q for q, w in enumerate(own) for k in places.get(w, ()))
            for shift, n in shifts.items():
                if n < need:
                    continue
                gain = best = equal = most = 0
                for q, w in enumerate(own):
                    if 0 <= q + shift < len(words):
                        same = words[q + shift] == w
                        gain, equal = (gain + 1, equal + 1) if same else (gain - decontaminate.MISMATCH, equal)
                        if gain < 0:
                            gain = equal = 0
                        if gain > best:
                            best, most = gain, equal
                if most >= need:
                    found[d, i] = max(found.get((d, i), 0), most)
    return found


@pytest.fixture(scope="module")
def leaks(spark, texts):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = bench.collect()
    changed = "Foo " + " ".join(w if i % 6 else "zzz" for i, w in enumerate(items[0].text.split()))
    more = spark.createDataFrame([(90001, changed), (None, items[1].text.upper()), (90002, "xx short item here yy"),
                                  (90003, "short item nothere"), (90004, " ".join(items[2].text.split()[:11]))], "doc_id long, text string")
    odd = spark.createDataFrame([(5001, "short, item HERE"), (5002, None), (5003, ""), (5004, "..."), (5001, "short item here"), (None, items[3].text)],
                                "item_id long, text string")
    return texts.union(more), bench.union(odd)


@pytest.mark.parametrize("size", [decontaminate.BENCH_BYTES, 3000])
def test_overlaps(leaks, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "BENCH_BYTES", size)
    docs, bench = leaks
    rows = overlaps(docs, bench).collect()
    expected = plain_overlaps([tuple(x) for x in docs.collect()], [tuple(x) for x in bench.collect()])
    got = {}
    for x in rows:
        got[x.doc_id, x.item_id] = max(got.get((x.doc_id, x.item_id), 0), x.n_equal)
        assert 5 * x.n_equal >= 4 * x.n_words
    assert got == expected
    assert {(90001, 0), (None, 1), (90002, 5001)} <= set(got) and not {d for d, _ in got} & {90003, 90004}
    assert sum(x.item_id == 5001 for x in rows) == 2


def test_without_overlaps(leaks, odd, nothing):
    docs, bench = leaks
    hit = {d for d, _ in plain_overlaps([tuple(x) for x in docs.collect()], [tuple(x) for x in bench.collect()]) if d is not None}
    kept = {x.doc_id for x in without_overlaps(docs, bench).collect()}
    assert not kept & hit and kept | hit | {None} >= {x.doc_id for x in docs.collect()}
    assert with_overlaps(odd, bench).columns == [c for c in odd.columns if c != "hits"] + ["hits"]
    assert without_overlaps(odd, bench.limit(0)).count() == odd.count()
    assert overlaps(nothing, bench).collect() == []


def fold_of(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def test_base_scores(texts):
    rows = texts.collect()
    words = [(x.text or "").encode().lower().split() + ["end"] for x in rows]
    counts = Counter(w for x, ws in zip(rows, words) if fold_of(x.doc_id) != 1 for w in ws)
    total, size = sum(counts.values()), len(counts)
    expected = Counter()
    for x, ws in zip(rows, words):
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (size + 1))) for w in ws)
        expected[x.doc_id, x.text, fold_of(x.doc_id) == 1, len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 5)] += 1
    got = Counter((x.doc_id, x.text, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 5))
                  for x in score_texts(texts).collect())
    assert got == expected


def test_model_predicts_held_out_texts_better_than_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [x for x in score_texts(docs).collect() if x.held_out]
    n = sum(x.n_tokens for x in rows)
    assert sum(x.score for x in rows) / n > sum(x.base_score for x in rows) / n + 0.15
    assert sum(x.score > x.base_score for x in rows) > 0.9 * len(rows)


def test_class_probabilities_add_up(spark):
    vocabulary = Vocabulary(np.array([3, 9], np.uint64), np.array([5, 7] + [2] * bilinear.ENDINGS), np.ones(2 + bilinear.ENDINGS, np.int64), 20, 9)
    model = Model.initial(vocabulary)
    near, far = model.tables()
    normal = bilinear._normalisers(spark, model, 2)
    for a, b in ((0, 1), (4, vocabulary.classes), (vocabulary.classes, vocabulary.classes)):
        assert abs(np.exp(near[a] + far[b] - normal[a, b]).sum() - 1) < 1e-4
    ending = 2  # a class's known tokens and its unseen ones
    share = (vocabulary.counts[ending] + 0.5 * vocabulary.distinct[ending]) + 0.5
    assert share == vocabulary.counts[ending] + 0.5 * (vocabulary.distinct[ending] + 1)


def test_scores_without_training_texts(spark, nothing, odd):
    ids = [i for i in range(40) if fold_of(i) == 1][:2]
    rows = score_texts(spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")).collect()
    assert all(x.train_tokens == 0 and x.n_known == 0 and x.base_score == 0 and math.isfinite(x.score) for x in rows)
    assert score_texts(nothing).collect() == []
    assert score_texts(odd).count() == odd.count()


def test_pipeline(spark, documents):
    """Every stage by brute force, on what the stage before kept."""
    rows = {x.doc_id: x for x in documents.collect()}
    kept = {x.doc_id for x in quality.judged(documents).filter("kept").collect()}
    for i in kept:
        m = plain_measures(rows[i].text)
        assert m["n_words"] >= 50 and 100 * m["n_repeat_words"] <= 50 * m["n_words"] and m["n_symbols"] <= 0.1 * m["n_words"]
    ids = sorted(kept)
    groups = plain_groups([plain_fingerprint(rows[i].text) for i in ids], 4)
    ids = [i for k, i in enumerate(ids) if groups[k] == k]
    units = [rows[i].text.encode().split() for i in ids]
    counts = windows_of(units, 35)
    left = {}
    for i, words in zip(ids, units):
        gone = covered(words, 35, counts)
        if not all(gone):
            left[i] = b" ".join(w for w, g in zip(words, gone) if not g).decode() if any(gone) else rows[i].text
    items = [tuple(x) for x in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaking = {d for d, _ in plain_overlaps(left.items(), items)}
    pieces = Pieces(public_tokenizers.path("piece_bpe_32k.model"), "rank")
    expected = {i: (text, len(text) if text != rows[i].text else rows[i].n_chars, rows[i].lang, rows[i].source, pieces.encode(text).tolist())
                for i, text in left.items() if i not in leaking}
    got = {x.doc_id: (x.text, x.n_chars, x.lang, x.source, x.ids) for x in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == expected
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "substring dedup",
                                                            "benchmark decontamination", "sentencepiece"]


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, documents, stage):
    name, function = corpus_pipeline.STAGES[stage]
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, " ", None, None, None)], documents.schema)
    assert function(spark, odd, SF_DIR).columns[:5] == documents.columns
    assert function(spark, documents.limit(0), SF_DIR).collect() == []
    function(spark, odd, SF_DIR).collect()
