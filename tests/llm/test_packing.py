"""Retrieval packing against brute-force BM25 and a plain greedy."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import packing
from tessera.llm.packing import pack
from tests.llm.test_texts import docs  # noqa: F401


def _bm25(query, documents, idf, mean):
    """Scores of plain BM25 (k1 1.2, b 0.75) of all documents for a query's distinct terms."""
    terms = [Counter(d.tolist()) for d in documents]
    return [sum(idf[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in set(query.tolist()) if t in tf)
            for d, tf in zip(documents, terms)]


def test_index_scores_equal_brute_force(spark, docs):
    ids = packing.materialize(packing.tokenized(docs.repartition(5)), "ids")
    df, n, mean = packing.document_frequencies(ids)
    rows = [np.frombuffer(r.ids, "<u2") for r in ids.collect()]
    seen = Counter(t for x in rows for t in set(x.tolist()))
    assert (n, mean) == (len(rows), pytest.approx(sum(map(len, rows)) / len(rows)))
    assert {t: k for t, k in enumerate(df.tolist()) if k} == seen
    idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
    index = packing.Index(rows, idf, mean)
    for query in rows:
        assert index.scores(query) == pytest.approx(_bm25(query, rows, idf, mean), rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("most", [400, 10_000])
def test_a_seed_takes_its_best_unused_neighbours(most):
    """Windows against a plain greedy: the seed first, then by score among the unused, a
    cut document seeds the next window; with and without refills of the shard."""
    random = np.random.default_rng(3)
    rows = [(k, 0, 0, np.append(random.integers(10 + 40 * (k % 5), 70 + 40 * (k % 5), random.integers(0, 60)), 2).astype("<u2"))
            for k in range(60)]
    idf, mean, window = random.uniform(1, 3, 1 << 16).astype(np.float32), 30.0, 100
    idf[2] = 0
    filler, got = packing.Filler(idf, mean, window, 0), []
    for row in rows:
        filler.rows.append(row)
        if sum(len(r[3]) for r in filler.rows) >= most:
            got += filler.fill(most // 2, most // 2)
    got += [*filler.fill(0, 0), *filler.rest()]

    pool, expected, sequence, seed = [], [], 0, None

    def fill(left):
        nonlocal sequence, seed
        shard = list(pool)
        texts = [x for _, _, x in shard]  # what was unused when the shard was indexed
        at = {d: 0 for d, _, _ in shard}
        while (total := sum(len(x) - at[d] for d, _, x in shard)) >= window and total > left:
            unused = [i for i, (d, _, x) in enumerate(shard) if at[d] < len(x)]
            first = next((i for i in unused if shard[i][0] == seed), unused[0])
            score = _bm25(texts[first], texts, idf, mean)
            order, offset, seed = [first, *sorted((i for i in unused if i != first), key=lambda i: -round(score[i], 3))], 0, None
            for i in order:
                doc, start, x = shard[i]
                take = min(len(x) - at[doc], window - offset)
                expected.append((doc, start + at[doc], take, sequence, offset))
                at[doc], offset = at[doc] + take, offset + take
                if offset == window:
                    seed = doc if at[doc] < len(x) else None
                    break
            sequence += 1
        pool[:] = sorted(((d, s + at[d], x[at[d]:]) for d, s, x in shard if at[d] < len(x)), key=lambda r: r[0] != seed)

    for doc, _, start, x in rows:
        pool.append((doc, start, x))
        if sum(len(x) for _, _, x in pool) >= most:
            fill(most // 2)
    fill(0)
    offset = 0
    for doc, start, x in pool:
        expected.append((doc, start, len(x), sequence, offset))
        offset += len(x)
    assert [(r[0], r[1], r[2], r[5], r[6]) for r in got] == expected


def test_equal_texts_share_the_shard_key(spark):
    """Copies from different partitions get one key, and rows without a counting term the last resort."""
    rows = [(k, f"alpha{k % 7} beta gamma{k % 7} delta") for k in range(70)] + [(100, None), (101, "")]
    ids = packing.materialize(packing.tokenized(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)), "ids")
    df, n, _ = packing.document_frequencies(ids)
    idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
    idf[packing.END_ID] = 0
    router = spark.sparkContext.broadcast(packing.fitted_router(ids, df, idf, 4096))
    keys = defaultdict(set)
    for r in packing._routed(ids, router, 4096).collect():
        keys[r.doc_id % 7 if r.doc_id < 100 else -1].add((r.near, r.first, r.second))
    assert all(len(k) == 1 for k in keys.values()) and next(iter(keys[-1]))[1:] == (-1, -1)


def test_packing_brings_far_documents_together(spark):
    """Documents of a topic lie in different partitions, none has its topic near."""
    rows = [(k * 100 + t, " ".join(f"{chr(97 + t)}{chr(97 + w)}qx{t}" for w in range(26)) * 5)
            for k in range(4) for t in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(4, "doc_id")
    window = 4 * packing.tokenized(docs).agg(F.max("n")).first()[0]
    together = defaultdict(set)
    for r in pack(docs, window=window).collect():
        together[r.sequence_id].add(r.doc_id)
    met = {d for ids in together.values() for d in ids if any(x % 100 == d % 100 and x != d for x in ids)}
    assert len(met) >= len(rows) // 2
    assert pack(docs.limit(0)).collect() == []


def test_words_are_looked_up_without_their_signs():
    """Ids are the library's, and one entry a word serves whatever signs follow it."""
    from tokenizers import Tokenizer

    tokenizer, memo, _ = packing._tokenizer(None)
    whole = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))
    texts = ["", " ", "\n\n", "Qzarvo, qzarvo. QZARVO!? (qzarvo) qzarvo's  Été, été-là étéß", "a\tb c", "é, 日本!",
             "<|endoftext|>x y<|startoftext|>, İstanbul ſ", "x" * 5000]
    memo.clear()
    got = packing.token_bytes(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        [*whole.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    assert "qzarvo" in memo and not {"qzarvo,", "qzarvo.", "qzarvo!?"} & set(memo)


def test_a_batch_is_read_as_its_documents_are(monkeypatch):
    """Distinct terms, features and drawn terms of many documents at once."""
    random = np.random.default_rng(5)
    docs = [random.integers(0, 300, random.integers(1, 80)).astype("<u2") for _ in range(50)]
    df = np.zeros(1 << 16, np.int64)
    for d in docs:
        df[np.unique(d)] += 1
    router = packing.Router(df, np.log1p(60 / (df + 0.5)).astype(np.float32))
    monkeypatch.setattr(packing, "SORTED_IDS", 200)
    assert [b - a for a, b in packing._groups(docs)] != [len(docs)]
    many = router.read(docs)
    for k, d in enumerate(docs):
        one = router.read([d])
        assert one[0][0] == pytest.approx(many[0][k]) and (one[1][0], one[2][0]) == (many[1][k], many[2][k])
        term, tf = np.unique(d, return_counts=True)
        weight = router.weight[term] * tf / (tf + packing.K1)
        term, weight = term[weight > 0], weight[weight > 0]
        for drawn, draws in zip(one[1:], router.draws):
            assert drawn[0] == (term[np.argmin(draws[term] / weight)] if len(term) else -1)


def test_workers_forget_their_words_after_tokenizing():
    from tessera.llm import packing

    texts = ["Some words, and some more words."] * 3
    ids = packing.token_bytes(texts)
    assert packing._tokenizer.cache_info().currsize
    packing._forget_words()
    assert not packing._tokenizer.cache_info().currsize
    packing._forget_words()
    assert packing.token_bytes(texts) == ids


def test_plain_words_are_merged_by_the_model_alone():
    """Lower-cased words of Latin letters need no normalizer and no search for pretokens."""
    from types import SimpleNamespace

    tokenizer, _, spelling = packing._tokenizer(None)
    words = ["qzarvo", "été", "straße", "ÿþð", "a", "é", "the", "àçéèêëîïôûù", "x" * 300]
    memo = packing._Ids()
    packing._learn_words(SimpleNamespace(model=tokenizer.model), memo, spelling, words[:4])
    packing._learn_words(SimpleNamespace(model=tokenizer.model), memo, spelling, words[4:])
    begin = [0, *memo.ends[:len(words)].tolist()]
    assert [memo.data[begin[memo[w]]:begin[memo[w] + 1]].tolist() for w in words] == [
        tokenizer.encode(w, add_special_tokens=False).ids for w in words]


def test_a_full_memo_starts_afresh(monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))
    texts = [f"word{k} Wört{chr(97 + k % 26)}{chr(97 + k // 26)}, other, {k}!" for k in range(90)]
    expected = [[*whole.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    monkeypatch.setattr(packing, "MEMO_WORDS", 70)
    monkeypatch.setattr(packing, "BATCH_CHARS", 300)
    packing._tokenizer(None)[1].clear()
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in packing.token_bytes(texts)] == expected
    assert 0 < len(packing._tokenizer(None)[1]) <= 70
    assert packing.token_bytes([""]) == [packing.END_ID.to_bytes(4, "little")] and packing.token_bytes([]) == []


@pytest.mark.parametrize("kind", ["added", "unmarked"])
def test_another_tokenizer_reads_its_words_itself(kind, tmp_path):
    """An added token of letters, or a pretokenizer that changes words."""
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))
    if kind == "added":
        whole.add_tokens(["arv"])
    else:
        whole.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(
            add_prefix_space=True, use_regex=False)])
    whole.save(path := str(tmp_path / "tokenizer.json"))
    texts = ["qzarvo the été", "the", "qzarvo qzarvo straße"]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.token_bytes(texts, path)] == [
        [*whole.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
