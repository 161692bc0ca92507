"""Operators over whole corpora, against brute force."""

import random
import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_model, simhash, substring_dedup
from tidemark.llm.components import components
from tidemark.llm.decontamination import (
    TERM,
    Items,
    Retrieval,
    answer_of,
    find_leaks,
    fit_matcher,
    numbered_texts,
    numbers_of,
    terms,
)
from tidemark.llm.language_model import (
    Adam,
    Attention,
    Insides,
    ModelOptions,
    Scorer,
    Subwords,
    class_slots,
    default_vocabulary,
    found,
    grouped,
    score_texts,
    softmax,
    windows,
    within,
)
from tidemark.llm.mixing import letter_share, mix_sources, stored
from tidemark.llm.substring_dedup import dedup_substrings

WORD = r"[^\x20\x09-\x0D]+"
SMALL = ModelOptions(groups=24, singles=16, dims=8, steps=20)


def smallest_reachable(ids, linked):
    label = dict(zip(range(len(ids)), ids))
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return [label[i] for i in range(len(ids))]


# SimHash


def check_groups(found):
    found = sorted(found, key=lambda r: r["doc_id"])
    prints = [int(r["fingerprint"], 16) for r in found]
    linked = [
        (i, j)
        for i in range(len(prints))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 4
    ]
    want = smallest_reachable([r["doc_id"] for r in found], linked)
    assert [r["component_id"] for r in found] == want
    return linked


def test_simhash_groups_are_exact(documents):
    assert check_groups(simhash.simhash_components(documents).collect())


def test_crowded_buckets_lose_no_link(spark, documents, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    check_groups(simhash.simhash_components(documents).collect())


@pytest.mark.parametrize("thresholds", [(0, 1, 2), (3, 0, -1), (-1, 1, 2)])
def test_unequal_thresholds_find_every_pair(spark, thresholds):
    """Thresholds that add up to distance - parts + 1 lose nothing, whatever their shares."""
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 40)
    near = [int(b) ^ sum(1 << int(i) for i in draw.choice(63, 4, False)) for b in base for _ in "ab"]
    prints = [int(b) for b in base] + near
    table = spark.createDataFrame([(p,) for p in prints], "fp long").distinct()
    bits = [tuple(range(0, 21)), tuple(range(21, 42)), tuple(range(42, 64))]
    parts = [simhash.Partition(b, t) for b, t in zip(bits, thresholds) if t >= 0]
    distance = sum(thresholds) + 2
    edges = simhash.near_edges(simhash.in_blocks(simhash.signatures(table, parts)), distance)
    root = {p: p for p in prints}
    root.update((r["node"], r["root"]) for r in components(edges).collect())
    for p in prints:
        for q in prints:
            if (p ^ q).bit_count() <= distance:
                assert root[p] == root[q]


def test_thresholds_add_up():
    cost, chosen = simhash.allocate([[0, 1, 9, 99], [0, 100, 200, 300], [0, 2, 3, 90]], 0)
    assert sum(chosen) == 0 and cost == min(1 + 100 + 2, 0 + 200 + 2, 9 + 0 + 2, 1 + 0 + 3)


def test_chain_components(spark):
    nodes = list(range(60))
    random.Random(4).shuffle(nodes)
    chain = spark.createDataFrame(list(zip(nodes, nodes[1:])), "u long, v long")
    found = components(chain).collect()
    assert {r["root"] for r in found} == {0} and len(found) == 59


def test_simhash_odd_rows(odd, empty):
    rows = simhash.simhash_components(odd).collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {r["fingerprint"] for r in zero} == {"0" * 16}
    assert {r["component_id"] for r in zero} == {1}
    assert simhash.simhash_components(empty).count() == 0


# Substrings


def removed(docs, window):
    found = {}
    first = {}
    for doc, text in sorted(docs):
        tokens = re.findall(WORD, text)
        for i in range(len(tokens) - window + 1):
            first.setdefault(tuple(tokens[i : i + window]), doc)
    for doc, text in docs:
        tokens = re.findall(WORD, text)
        gone = {
            i + k
            for i in range(len(tokens) - window + 1)
            if first[tuple(tokens[i : i + window])] < doc
            for k in range(window)
        }
        found[doc] = " ".join(w for i, w in enumerate(tokens) if i not in gone)
    return found


def test_substrings_agree_with_brute_force(make):
    draw = random.Random(5)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for _ in range(40):
        words = [draw.choice("abcde") for _ in range(draw.randrange(40))]
        at = draw.randrange(len(words) + 1)
        words[at:at] = passage[draw.randrange(10) : draw.randrange(10, 31)]
        texts.append(draw.choice([" ", "\n"]).join(words))
    docs = make(*texts)
    for window, gram in ((13, 3), (5, 2)):
        found = dedup_substrings(docs.repartition(5), window, gram).collect()
        want = removed(list(enumerate(texts)), window)
        assert {r["doc_id"]: r["kept_text"] for r in found} == want


def test_large_buckets_are_split(make, monkeypatch):
    draw = random.Random(8)
    passage = [f"p{i}" for i in range(20)]
    texts = [" ".join([f"a{i}", *passage, f"b{i}", *draw.choices("xy", k=14)]) for i in range(200)]
    docs = stored(make(*texts).repartition(3), "texts")
    want = removed(list(enumerate(texts)), 13)
    for name, value in (("HOT", 10), ("SAMPLE", 1)):
        monkeypatch.setattr(substring_dedup, name, value)
    found = dedup_substrings(docs).collect()
    assert {r["doc_id"]: r["kept_text"] for r in found} == want

    def largest(hot):
        blocks = substring_dedup.pack_rows(docs, 13, 3, 1, hot).collect()
        rows = substring_dedup.from_blocks([bytes(r["block"]) for r in blocks])
        kept = rows.filter(rows["packed"].is_valid())["bucket"].to_pylist()
        return max(map(kept.count, set(kept)))

    assert largest(frozenset()) > 100
    assert largest(substring_dedup.hot_buckets(docs, 13, 3)) <= 20


def test_a_window_in_every_text_leaves_a_task_in_few_rows(make):
    """Folded over all slices of a task, not by slice."""
    passage = " ".join(f"p{i}" for i in range(13))
    docs = stored(make(*[f"a{i} {passage} b{i} " + "z" * 400_000 for i in range(60)]).coalesce(1), "texts")
    everything = substring_dedup.Buckets(b"\xff" * (substring_dedup.FILTER_BITS // 8))
    blocks = substring_dedup.pack_rows(docs, 13, 3, 1, everything).collect()
    assert len(blocks) > 3
    rows = substring_dedup.from_blocks([bytes(r["block"]) for r in blocks])
    assert sum(p == passage.encode() for p in rows["packed"].to_pylist()) <= 3


def test_the_filter_has_all_large_buckets(spark):
    bits = np.zeros(substring_dedup.FILTER_BITS // 8, np.uint8)
    for bucket in (-5, 3, 2**62):
        place = bucket % substring_dedup.FILTER_BITS
        bits[place >> 3] |= 1 << (place & 7)
    held = substring_dedup.Buckets(bits.tobytes())
    assert -5 in held and 3 in held and 2**62 in held and 4 not in held


def test_substrings_of_odd_rows(odd, empty):
    rows = dedup_substrings(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 4, 5, None))
    assert dedup_substrings(empty).count() == 0


# Mixing


def water_filling(sizes, weights, most):
    total, left, out = sum(sizes), set(range(len(sizes))), {}
    while left:
        share = (total - sum(out.values())) / sum(weights[i] for i in left)
        over = {i for i in left if share * weights[i] >= most * sizes[i]}
        if not over:
            return [out.get(i, share * weights[i]) for i in range(len(sizes))]
        out.update((i, most * sizes[i]) for i in over)
        left -= over
    return [out[i] for i in range(len(sizes))]


def test_mix_reaches_its_targets(spark, documents):
    rows = mix_sources(documents, keep=["doc_id", "source"]).collect()
    again = mix_sources(documents.repartition(3), keep=["doc_id", "source"]).collect()
    assert sorted(rows) == sorted(again)
    names = sorted({r["source"] for r in rows})
    size = [next(r["source_size"] for r in rows if r["source"] == n) for n in names]
    assert size == [sum(r["size"] for r in rows if r["source"] == n) for n in names]
    want = water_filling(size, [1 + i % 3 for i in range(len(names))], 3)
    for name, target in zip(names, want):
        own = [r for r in rows if r["source"] == name]
        assert own[0]["target"] == pytest.approx(target, rel=1e-9)
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)
        assert all(r["taken"] <= 3 * r["size"] for r in own)
        whole = min(r["taken"] // r["size"] for r in own if r["size"])
        assert all(r["taken"] in (whole * r["size"], (whole + 1) * r["size"]) for r in own)


def test_mix_takes_the_smallest_keys(spark, documents):
    """Against a sort of each source by its keys: exponential, scaled by quality."""
    draws = documents.select(
        "doc_id", F.xxhash64(F.lit(42), "doc_id").alias("drawn"), letter_share(F.col("text")).alias("w")
    )
    keys = {
        r["doc_id"]: -np.log(((r["drawn"] % 2**64 >> 11) + 0.5) / 2.0**53) / r["w"]
        for r in draws.collect()
    }
    rows = mix_sources(documents, keep=["doc_id", "source"]).collect()
    for name in {r["source"] for r in rows}:
        own = sorted((r for r in rows if r["source"] == name), key=lambda r: keys[r["doc_id"]])
        rest = own[0]["target"] - own[0]["epochs"] * own[0]["source_size"]
        before = 0
        for r in own:
            assert r["sampled"] == (before + r["size"] / 2 <= rest and rest > 0), r
            before += r["size"]


def test_rows_without_an_id_have_keys_of_their_own(spark):
    rows = [(None, f"word {n} " * 5, "a", "") for n in range(400)] + [(1, "b " * 4000, "b", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = [r for r in mix_sources(docs, (1, 3), keep=["source"]).collect() if r["source"] == "a"]
    taken = sum(r["taken"] for r in found)
    assert abs(taken - found[0]["target"]) <= 10 and 0 < sum(r["sampled"] for r in found) < 400


def test_mix_of_odd_rows(spark, odd, empty):
    rows = mix_sources(odd).collect()
    assert len(rows) == odd.count()
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert mix_sources(empty).count() == 0


# Decontamination


def test_leaks_and_paraphrases(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = sorted(items.collect())
    squeeze = lambda t: " ".join(t.split())
    inside = {
        d["doc_id"]
        for d in documents.collect()
        for r in rows
        if squeeze(r["text"]) in squeeze(d["text"] or "")
    }
    words = rows[0]["text"].split()
    changed = " ".join(w for i, w in enumerate(words) if i % 6)
    backwards = " ".join(reversed(words))
    filler = documents.filter("doc_id = 1").first()["text"]
    more = spark.createDataFrame(
        [(10_001, f"{filler} {changed} {filler}"), (10_002, f"{filler} {backwards}")],
        "doc_id long, text string",
    )
    docs = documents.select("doc_id", "text").union(more)
    found = {r["doc_id"]: r["item_ids"] for r in find_leaks(docs, items).collect() if r["contaminated"]}
    assert inside <= set(found)
    assert found[10_001] == [rows[0]["item_id"]]
    assert 10_002 not in found
    blocks = find_leaks(docs, items, Retrieval(block=15)).filter("contaminated").collect()
    assert inside | {10_001} <= {r["doc_id"] for r in blocks}


def test_leaks_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "a question of many words here? the answer"), (2, None), (None, ""), (3, "?!")],
        "item_id long, text string",
    )
    assert find_leaks(odd, items).count() == odd.count()
    assert find_leaks(empty, items).count() == 0
    assert find_leaks(odd, items.limit(0)).filter("contaminated").count() == 0


def test_latent_space_is_that_of_all_passages(spark, make):
    """Some 30,000 passages, against the eigenvectors of all of them."""
    draw = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(12)])
    odds = 0.7 ** np.arange(12)
    texts = [" ".join(words[draw.choice(12, 25_600, p=odds / odds.sum())]) for _ in range(37)]
    options = Retrieval()
    items = Items.of([(1, " ".join(words[:8]), ""), (2, " ".join(words[4:]), "")])
    docs = numbered_texts(make(*texts, "", None), items, ["doc_id"])
    matcher = fit_matcher(docs, items, options)

    known = [np.array([int(w[1:]) for w in t.split()]) for t in texts]
    numbers = np.array([items.vocabulary[w] for w in words])
    rows = [numbers[k[s : s + 64]] for k in known for s in range(0, len(k) - 32, 32)]
    assert len(rows) > 29_000
    counts = np.array([np.bincount(r, minlength=12) for r in rows])
    # A null and an empty text have one passage without a word each.
    idf = np.log((len(rows) + 3) / ((counts > 0).sum(axis=0) + 1)) + 0.1
    np.testing.assert_allclose(matcher.idf, idf)

    def vectors(counts):
        weights = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
        return weights / np.linalg.norm(weights, axis=1, keepdims=True)

    corpus, bench = vectors(counts), vectors(np.array([np.bincount(t, minlength=12) for t in items.terms]))
    gram = corpus.T @ corpus + len(rows) / 2 * bench.T @ bench
    best = np.linalg.eigh(gram)[1][:, ::-1]
    np.testing.assert_allclose(np.abs(best.T @ matcher.space), np.eye(12), atol=2e-4)


def test_words_are_those_of_the_pattern():
    texts = ["foo_bar x-y z\x1cq \xa0 Stra\xdfe \xc9T\xc9 10\xb2 \xaa\xb5", "\u0391\u03a3 \u039f\u0394\u039f\u03a3. \u0130x", ""]
    texts += ["a".join(map(chr, range(256))), " ".join(map(chr, range(600)))]
    for text in texts:
        assert terms(text) == TERM.findall(text.lower())


def test_search_agrees_with_all_pairs(make):
    """Every passage against every item without the latent space: it may lose a tenth at most."""
    draw = np.random.default_rng(2)
    words = [f"v{i}" for i in range(400)]
    texts = [" ".join(draw.choice(words, 12)) for _ in range(20)]
    rows = []
    for n in range(120):
        item = texts[n % 20].split()
        part = [w for w in item if draw.random() > 0.2 * (n % 3)]
        noise = list(draw.choice(words, 150))
        at = int(draw.integers(150))
        rows.append(" ".join(noise[:at] + part + noise[at:]))
    options = Retrieval()
    items = Items.of([(i, t, answer_of(t)) for i, t in enumerate(texts)])
    docs = numbered_texts(make(*rows), items, ["doc_id"])
    matcher = fit_matcher(docs, items, options)
    found = wanted = 0
    for row in docs.collect():
        known = numbers_of(row["numbers"])
        near = [(s, u) for s in range(0, len(known), options.stride) for u in range(len(texts))]
        every = set(matcher.confirmed(known, near))
        hits = set(matcher.search(known, np.array([len(known)]))[0])
        assert hits <= every
        found, wanted = found + len(hits), wanted + len(every)
    assert wanted > 60 and found >= 0.9 * wanted


# Language model


def test_windows_score_each_token_once():
    for size in (1, 31, 32, 33, 100, 777):
        scored = [s + i for s, f in windows(size, SMALL) for i in range(f, min(32, size - s))]
        assert scored == list(range(size))


def test_gradients_agree_with_differences():
    model = Attention(ModelOptions(groups=5, dims=4, window=6), 6)
    model.weights = {k: w.astype(np.float64) for k, w in model.weights.items()}
    draw = np.random.default_rng(6)
    x, t = draw.integers(0, 6, (3, 6)), draw.integers(0, 5, (3, 6))
    _, grads = model.gradients(x, t)
    for name, weight in model.weights.items():
        at = tuple(draw.integers(0, s) for s in weight.shape)
        weight[at] += 1e-5
        up = model.gradients(x, t)[0]
        weight[at] -= 2e-5
        down = model.gradients(x, t)[0]
        weight[at] += 1e-5
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_later_tokens_do_not_matter():
    model = Attention(SMALL, SMALL.groups + 1)
    x = np.arange(32)[None] % SMALL.groups
    y = x.copy()
    y[0, 20:] = 0
    assert np.allclose(model.hidden(x)["y"][0, :20], model.hidden(y)["y"][0, :20], atol=1e-5)


def test_base_score_agrees_with_brute_force(spark, documents):
    rows = {r["doc_id"]: r for r in score_texts(documents, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*re.findall(WORD, t.translate(lower)), ""] for i, t in texts.items()}
    counts = {}
    for i, words in tokens.items():
        if not rows[i]["held_out"]:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        want = sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert rows[i]["base_score"] == pytest.approx(want, rel=1e-9)
        assert rows[i]["n_tokens"] == len(words) and rows[i]["train_tokens"] == n
        assert rows[i]["n_known"] == sum(w in counts for w in words)
        assert rows[i]["score"] < 0


def test_scores_of_odd_rows(odd, empty):
    rows = score_texts(odd, SMALL).collect()
    assert len(rows) == odd.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert score_texts(empty, SMALL).count() == 0


def test_words_are_remembered_alike():
    subwords = Subwords(default_vocabulary())
    assert list(subwords.ids(["a", "bcd", "a"])) == list(Subwords(default_vocabulary()).ids(["a", "bcd", "a"]))
    assert subwords.ids([]).tolist() == [subwords.end]


def test_short_texts_train_the_model(make):
    texts = make(*["red green blue", "blue red green", "one two three four five six"] * 10)
    drawn, trained = (score_texts(texts, replace(SMALL, steps=n)) for n in (0, 200))
    before, after = ({r["doc_id"]: r["score"] for r in t.collect()} for t in (drawn, trained))
    assert all(after[i] > before[i] + 1 for i in before)


def test_padding_does_not_train():
    model = Attention(SMALL, SMALL.groups + 1)
    draw = np.random.default_rng(7)
    x, t = draw.integers(0, SMALL.groups, (2, 4, 32))
    counted = np.arange(32) < draw.integers(1, 32, (4, 1))
    other = np.where(counted, t, 0)
    (loss, grads), (same, others) = (model.gradients(x, y, counted) for y in (t, other))
    assert loss == same and all(np.array_equal(grads[k], others[k]) for k in grads)


def test_subwords_of_one_group_differ_as_context():
    kinds = np.array([0, 0, 1, 1, 2])
    model = Attention(ModelOptions(groups=2, dims=8, window=4, steps=300), 5, kinds)
    # The next group depends on which subword of its group the input is.
    x = np.array([[4, 0, 2, 0], [4, 1, 3, 1]])
    t = np.array([[0, 1, 0, 1], [0, 0, 1, 0]])
    model.train(x, t, np.ones(x.shape, bool), ModelOptions(groups=2, steps=300, batch=8))
    logits = model.logits(model.hidden(x)["y"])
    assert (logits.argmax(-1)[:, 1:] == t[:, 1:]).all()
    assert np.allclose(logits, model.folded().logits(model.folded().hidden(x)["y"]), atol=1e-4)


def test_scorer_reads_subwords():
    group = np.array([0, 0, 1, 1])
    scorer = Scorer(Attention(SMALL, 5), group, SMALL)
    inputs, targets, counted = scorer.cut(np.array([0, 1, 2, 3]))
    assert inputs[0, :4].tolist() == [4, 0, 1, 2] and targets[0, :4].tolist() == [0, 0, 1, 1]
    assert counted.sum() == 4
    one, other = scorer.score([np.array([0, 2, 3]), np.array([1, 2, 3])])
    assert one != other


def test_rare_pairs_count_as_well(documents):
    few, all_of_them = (
        {(r["doc_id"], r["n_tokens"]): r["score"] for r in score_texts(documents, options).collect()}
        for options in (replace(SMALL, pairs=50), replace(SMALL, pairs=10**9))
    )
    assert few == pytest.approx(all_of_them, rel=1e-9)


def test_all_training_rows_train(spark, documents):
    def mean(options):
        rows = score_texts(documents.repartition(3), options).filter("held_out").collect()
        return sum(r["score"] for r in rows) / sum(r["n_tokens"] for r in rows)

    # A sample of next to nothing leaves the weights as drawn, unless all rows train them.
    sampled = replace(SMALL, sample=1)
    assert mean(sampled) > mean(replace(sampled, rounds=0)) + 0.05


def test_scores_do_not_depend_on_the_layout(documents):
    """The model is trained on shards dealt by hashes, so tables cut in any way score alike."""
    options = replace(SMALL, sample=2000, shard=5000)
    found = [
        {r["doc_id"]: r["score"] for r in score_texts(documents.repartition(n), options).collect()}
        for n in (1, 12)
    ]
    assert found[0].keys() == found[1].keys()
    for doc_id, score in found[0].items():
        assert abs(score - found[1][doc_id]) <= 1e-4 * abs(score)


def test_probabilities_add_up_to_one(documents):
    """Of all subwords that may come next, for any context: groups and what is in them."""
    texts = [r["text"] for r in documents.limit(30).collect()]
    path = default_vocabulary()
    subwords = Subwords(path)
    uses = np.bincount(
        np.concatenate([subwords.ids(re.findall(WORD, t)) for t in texts]), minlength=subwords.size
    ).astype(float)
    group, alone = grouped(uses, subwords.begins, SMALL.groups, SMALL.singles)
    model = Attention(SMALL, subwords.size + 1, np.append(group, SMALL.groups))
    inputs = np.array([[subwords.size, 5, 300, 7] + [9] * (SMALL.window - 4)])
    shares = softmax(model.logits(model.hidden(inputs)["y"]))[0, :4].astype(float)
    of_each = shares[:, group] * alone
    assert np.allclose(of_each.sum(axis=1), 1, atol=1e-5)
    # A pair that is known shifts weight within its group alone.
    ids = np.flatnonzero(~subwords.begins)[:50]
    counts = (np.sort(7 * len(group) + ids), np.arange(1.0, 51))
    insides = Insides.of(group, alone, subwords.begins, 5.0, counts)
    keys = 7 * len(group) + np.arange(len(group))
    n, total = found(insides.pairs, keys), found(insides.totals, within(keys, group))
    given = (n + 5.0 * alone) / (total + 5.0)
    assert np.allclose(np.bincount(group, given, SMALL.groups), 1)


def test_targets_alone_score_like_all_groups():
    """Also with a last class that is not full, and a batch that misses some classes."""
    draw = np.random.default_rng(8)
    for groups in (2, 7, 24):
        options = replace(SMALL, groups=groups)
        model = Attention(options, 30, slots=draw.permutation(groups))
        model.lean(draw.integers(0, 50, groups))
        x, t = draw.integers(0, 30, (3, 32)), draw.integers(0, max(2, groups - 9), (3, 32))
        counted = draw.random(t.shape) < 0.7
        every = model.logits(model.hidden(x)["y"])
        assert np.allclose(np.exp(every).sum(-1), 1, atol=1e-5)
        logs, at = model.logs(x, t, counted)
        assert sorted(at) == np.flatnonzero(counted).tolist()
        assert np.allclose(logs, np.take_along_axis(every, t[..., None], -1).ravel()[at], atol=1e-4)


def test_classes_hold_every_group_once():
    draw = np.random.default_rng(9)
    for groups in (2, 5, 24, 250):
        pairs = draw.integers(0, 9, (groups, groups)).astype(float)
        for p in (pairs, 0 * pairs):
            slots = class_slots(p, p.sum(axis=0))
            assert sorted(slots) == list(range(groups))


def test_a_token_needs_few_exponentials(monkeypatch):
    """In training and in scoring, far fewer than there are groups."""
    options = ModelOptions()
    made = []
    weigh = language_model.weigh
    monkeypatch.setattr(language_model, "weigh", lambda x: made.append(x.size) or weigh(x))
    group = np.arange(300) % options.groups
    scorer = Scorer(Attention(options, 301), group, options)
    cuts = scorer.cut(np.arange(32))
    Adam(scorer.model).step(*(np.repeat(c, 4, axis=0) for c in cuts), 0.01)
    assert sum(made) < 4 * 32 * 100
    made.clear()
    scorer.score([np.arange(32)] * 4)
    assert sum(made) < 4 * 32 * 100


def test_inputs_met_are_counted():
    draw = np.random.default_rng(10)
    model = Attention(SMALL, 40)
    adam, batches = Adam(model), draw.integers(0, 24, (3, 4, 32))
    for x in batches:
        adam.step(x, x, np.ones(x.shape, bool), 0.01)
    assert adam.met.tolist() == np.bincount(batches.ravel(), minlength=40).tolist()
