"""Packing, collocations and the conversation trie, against brute force."""

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

from tidemark.llm.collocations import PhraseOptions, collocations, word_counts
from tidemark.llm.packing import (
    OpenWindows,
    PackOptions,
    Subwords,
    best_fit,
    default_vocabulary,
    pack_documents,
    powers,
)
from tidemark.llm.prefix_trie import (
    conversation_trie,
    ordered_turns,
    prefix_trie,
    with_shared_heads,
)
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# Packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def check_packing(found, texts, tokenizer, window=2048, slack=8):
    """Every token of every document lies in one piece, every sequence is gapless and full."""
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for doc_id, text in texts:
        want[doc_id].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    assert set(by_doc) == set(want)
    for doc_id, pieces in by_doc.items():
        ids = Counter()
        for p in pieces:
            assert p["length"] == len(p["ids"]) // 4 > 0
            ids.update(enumerate(array("I", bytes(p["ids"])), p["start"]))
        assert ids == Counter(x for doc in want[doc_id] for x in enumerate(doc))
        assert {p["doc_tokens"] for p in pieces} == set(map(len, want[doc_id]))
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert window - slack <= at <= window or at & (at - 1) == 0
    return sequences


def test_packing_keeps_every_token(documents, tokenizer):
    found = pack_documents(documents.repartition(3)).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    sequences = check_packing(found, texts, tokenizer)
    tokens = sum(r["length"] for r in found)
    assert len(sequences) <= tokens // 2048 + 12


def test_packing_of_odd_rows(odd, empty, spark, tokenizer):
    found = pack_documents(odd).collect()
    check_packing(found, [(r["doc_id"], r["text"]) for r in odd.collect()], tokenizer)
    assert pack_documents(empty).collect() == []
    with pytest.raises(ValueError, match="names of results"):
        pack_documents(odd.withColumn("start", odd["size"]), keep=["start"])


def test_documents_that_share_no_window_are_cut(make, tokenizer):
    texts = ["word " * 1100] * 40
    found = pack_documents(make(*texts), PackOptions(block=5000)).collect()
    sequences = check_packing(found, list(enumerate(texts)), tokenizer)
    assert len(sequences) <= 40 * 1101 // 2048 + 12


def test_best_fit_takes_the_tightest_window():
    draw = random.Random(5)
    lengths = [draw.randint(1, 100) for _ in range(400)]
    left: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [w for w in range(len(left)) if left[w] >= length]
        if fits:
            w = min(fits, key=lambda w: left[w])
        else:
            w = len(left)
            left.append(100)
        left[w] -= length
    found = best_fit(lengths, 100)
    assert sorted(i for w in found for i in w) == list(range(400))
    # Windows with equal room are alike, so only how full they get is the same.
    assert sorted(sum(lengths[i] for i in w) for w in found) == sorted(100 - n for n in left)


def test_tree_finds_the_least_capacity():
    tree = OpenWindows(20)
    for window, room in enumerate([3, 20, 7, 7]):
        tree.put(window, room)
    assert [tree.tightest(n) for n in (1, 3, 4, 7, 8, 20)] == [3, 3, 7, 7, 20, 20]
    assert tree.take(20) == 1
    assert tree.tightest(8) is None


def test_words_have_the_ids_of_the_whole_text(tokenizer, monkeypatch):
    import pyarrow as pa

    from tidemark.llm import packing

    odd = [
        "",
        None,
        "a\x1cb\x85c\xa0d é É İ ΑΣ ΑΣ. ﬁ it's IT'S don't\x00y",
        " ́a\nb\r\n\t\x0b\x0c z",
        "long text, cut. " * 500,
        "Größe über naïve façade señor żółć привет Ελλάδα ǅ ſ ŉ ĳ ա 日本語 ꟊ 𞤀 a1 1a a.b.c e.g. x's. (ab) ab) 'ab,",
        "e\u0301te\u0301 n\u0303 \u212b \u1e9e o\u0308 \u0131 I\u0307 \u03a3\u03c3\u03c2 ab\u0301.",
    ]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in odd]
    words = Subwords(default_vocabulary())
    assert [list(array("I", i)) for i in words.ids(pa.array(odd))] == want
    monkeypatch.setattr(packing, "SLICE", 40)
    monkeypatch.setattr(packing, "REMEMBERED", 500)
    words = Subwords(default_vocabulary())
    assert [list(array("I", i)) for i in words.ids(pa.array(odd))] == want


def test_powers_add_up():
    assert list(powers(1500)) == [1024, 256, 128, 64, 16, 8, 4]


# Collocations


def brute_phrases(rows, least=30, within=80, most=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    result = []
    for lang, f in counts.items():
        longer = defaultdict(int)
        for phrase, n in f.items():
            if len(phrase) > 2 and n >= least:
                for size in range(2, len(phrase)):
                    for i in range(len(phrase) - size + 1):
                        part = phrase[i : i + size]
                        longer[part] = max(longer[part], n)
        found = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least or 100 * longer[phrase] >= within * a > 0 and longer[phrase]:
                continue
            cuts = [
                (2000000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase))
            ]
            score, k = min(cuts)
            text = " ".join(phrase)
            found.append((-score, -a, text.encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, text, left, right) in enumerate(sorted(found)[:most], 1):
            result.append((lang, rank, text.decode(), -a, left, right, sizes[lang], -score))
    return sorted(result)


def phrase_rows(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("least", [30, 4])
def test_collocations_equal_brute_force(documents, least):
    rows = [(r["lang"], r["text"]) for r in documents.collect()]
    want = brute_phrases(rows, least)
    assert want
    assert phrase_rows(collocations(documents.repartition(5), PhraseOptions(least=least))) == want


def test_words_beyond_the_dictionary_count_as_well(documents):
    rows = [(r["lang"], r["text"]) for r in documents.collect()]
    found = collocations(documents, PhraseOptions(least=5, dictionary=40, part=2000))
    assert phrase_rows(found) == brute_phrases(rows, 5)


def test_common_words_are_dealt_apart(documents, monkeypatch):
    from tidemark.llm import collocations as module

    monkeypatch.setattr(module, "COMMON", 50)
    rows = [(r["lang"], r["text"]) for r in documents.collect()]
    assert phrase_rows(collocations(documents, PhraseOptions(least=5))) == brute_phrases(rows, 5)


def test_bins_are_counted_one_by_one(documents, monkeypatch):
    from tidemark.llm import collocations as module

    monkeypatch.setattr(module, "BIN_WORDS", 100)
    monkeypatch.setattr(module, "COMMON", 50)
    rows = [(r["lang"], r["text"]) for r in documents.collect()]
    found = collocations(documents, PhraseOptions(least=5, dictionary=40, part=2000))
    assert phrase_rows(found) == brute_phrases(rows, 5)


def test_windows_of_a_part_are_one_row_for_each_bin(documents, spark):
    from tidemark.llm import collocations as module

    texts = documents.select("lang", "text").repartition(2)
    options = PhraseOptions(least=1)
    words = module.vocabulary(word_counts(texts), options)
    blocks = module.packed(texts, words, options, 7, 3).collect()
    # Seven bins for each task and language, whose texts here are less than a part.
    langs = len({r["lang"] for r in blocks})
    assert len(blocks) <= 7 * 2 * langs * 2
    assert {r["bin"] for r in blocks} <= set(range(7))
    n = int(module.unpacked_windows([bytes(r["block"]) for r in blocks], [0] * len(blocks))[1].sum())
    pieces = (re.split(r"[.,;:!?\x0A-\x0D]", r["text"] or "") for r in documents.collect())
    words_of = [re.findall(r"[^\x20\x09]+", piece) for found in pieces for piece in found]
    assert n == sum(max(0, len(words) - 1) for words in words_of) > 20 * len(blocks)


@pytest.mark.parametrize("most, several", [(40, 1), (2**62, 1), (2**62, 3)])
def test_packed_windows_are_folded_like_plain_ones(most, several):
    import numpy as np

    from tidemark.llm.collocations import folded_windows, packed_windows, unpacked_windows

    draw = np.random.default_rng(3)
    least, common, bins = 5, 3, 4
    # Small numbers are frequent, and some of the others are hashes.
    names = np.concatenate([np.arange(1, 30), draw.integers(most // 2, most, 10)])
    at = np.minimum(draw.geometric(0.3, (4, 4000)) - 1, len(names) - 1)
    columns = [np.array(c) for c in names[at].astype(np.int64)]
    columns[2][:500] = columns[3][:900] = 0
    langs = draw.integers(0, several, 4000)
    plain = Counter()
    for lang, *window in zip(langs.tolist(), *(c.tolist() for c in columns)):
        plain.update({(lang, *window[:k]) for k in (2, 3, 4) if 0 not in window[:k]})
    held = defaultdict(list)
    for half in (slice(0, 1500), slice(1500, 4000)):
        for lang in range(several):
            part = [c[half][langs[half] == lang] for c in columns]
            for place, block in zip(*packed_windows(part, str(lang), bins, common)):
                held[int(place)].append((block, lang))
    assert len(held) == bins
    found = Counter()
    for blocks in held.values():
        words, n, of = folded_windows(*unpacked_windows(*zip(*blocks)), least, common)
        for lang, *window, times in zip(of.tolist(), *(c.tolist() for c in words), n.tolist()):
            found.update({(lang, *window[:k]): times for k in (2, 3, 4) if 0 not in window[:k]})
    often = lambda counts: {p: n for p, n in counts.items() if n >= least}
    assert often(found) == often(plain)
    assert any(len(p) == 5 for p in often(plain))
    # A window keeps its last words only where they are frequent, or lie in several bins.
    assert all(n >= least for p, n in found.items() if len(p) == 5)
    assert len(found) < len(plain) / 4


def test_small_languages_of_a_bin_are_counted_together(spark, monkeypatch):
    from tidemark.llm import collocations as module

    rows = [(f"l{i % 40}", f"a b c{i % 3}. a b d e, a b c{i % 3}") for i in range(4000)]
    made = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    want = brute_phrases(rows)
    for together in (0, 1 << 17):
        monkeypatch.setattr(module, "TOGETHER", together)
        assert phrase_rows(collocations(made)) == want


def test_collocations_of_odd_rows(odd, empty, spark):
    assert collocations(empty).collect() == []
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert phrase_rows(collocations(odd)) == brute_phrases(rows)
    texts = ["New York, new york! new york new", "\x0b\x0cnew york a\x1cb", None, ""] * 10
    made = spark.createDataFrame([(t, None) for t in texts], "text string, lang string")
    assert phrase_rows(collocations(made)) == brute_phrases([(None, t) for t in texts])


def test_ties_go_by_phrase(spark):
    texts = ["b a. d c. é z. z é"] * 30
    made = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    found = phrase_rows(collocations(made))
    assert [r[2] for r in found] == ["b a", "d c", "z é", "é z"]
    assert found == brute_phrases([("en", t) for t in texts])


def test_a_text_longer_than_a_part(spark):
    texts = ["one two three four five, " * 300, "x" * 1000 + " one two"]
    made = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    for part in (1, 7, 100):
        found = phrase_rows(collocations(made, PhraseOptions(part=part)))
        assert found == brute_phrases([("en", t) for t in texts])
    assert {r["word"]: r["n"] for r in word_counts(made.select("lang", "text")).collect()}["one"] == 301


# Conversation trie


def brute_trie(rows, family=5, most=9):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: sorted(t) for c, t in turns.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % most
        base = turns.get(c - c % family, [])
        rebuilt[c] = [t[2:] for t in base[:h] + turns[c][h:]]
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
            if d:
                children[tuple(t[: d - 1])].add(tuple(t[:d]))
        ends[tuple(t)].append(c)
    leaves, saved = Counter(), Counter()
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted(
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else -1,
            len(m),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def trie_rows(found):
    rows = [tuple(r) for r in found.collect()]
    return sorted((c, d, -1 if p is None else p, *rest) for c, d, p, *rest in rows)


TURNS = "conv_id long, turn long, role string, text string"


def test_trie_equals_brute_force(spark):
    found = QUERIES["op13_conversation_trie"](spark, SF)
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    want = brute_trie([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows])
    assert trie_rows(found) == want


def test_deep_conversations_cross_many_bands(spark):
    draw = random.Random(2)
    rows = []
    for c in range(40):
        same = draw.randint(0, 90)
        n = same + draw.randint(0, 12)
        rows += [(c, t, "u", "s" if t < same else draw.choice("ab")) for t in range(n)]
    made = spark.createDataFrame(rows, TURNS)
    turns, convs = with_shared_heads(ordered_turns(made), 5, 9)
    want = brute_trie(rows)
    assert max(r[1] for r in want) > 64
    for band in (3, 16):
        assert trie_rows(prefix_trie(turns, convs, band)) == want


def test_trie_of_odd_rows(spark):
    made = spark.createDataFrame([], TURNS)
    assert conversation_trie(made).collect() == []
    rows = [
        (3, None, None, None),
        (3, None, "", ""),
        (3, 1, "user", "é" * 3),
        (3, 1, "user", "é" * 3),
        (0, 2, "a", "b"),
        (0, 2, "a", "a"),
        (None, 1, "user", "none"),
        (4, 1, "ab", "c"),
        (9, 1, "a", "bc"),
        (12, 1, "a", "bc"),
        (17, 0, "x", "y" * 100_000),
    ] + [(50, 0, "u", "again")] * 300
    made = spark.createDataFrame([(*r, 1, "p") for r in rows], TURNS + ", place int, part string")
    assert trie_rows(conversation_trie(made)) == brute_trie(rows)
