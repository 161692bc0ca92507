"""Operators that judge each text by itself."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import string
import zlib
from urllib.parse import quote

import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import secrets
from tidemark.llm.quality_rules import QualityRules, judge, quality_rules
from tidemark.llm.queries import PII_KEY, URL_RULES
from tidemark.llm.rule_ensemble import fit_rules, score_quality, train_quality
from tidemark.llm.secrets import find_secrets, listed, scan_secrets
from tidemark.llm.surrogates import Surrogates, iban_check, luhn, replace_entities, replace_pii
from tidemark.llm.url_filter import filter_urls

HEX = "0123456789abcdef" * 2


# Quality rules


def covered_by_repeats(tokens):
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_counts_agree_with_brute_force():
    draw = random.Random(1)
    for _ in range(50):
        text = "".join(draw.choice("ab#<> \n") for _ in range(draw.randrange(60)))
        tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = text.split("\n")
        found = judge(text, QualityRules(), zstandard.ZstdCompressor())
        repeats = sum(bool(x.strip()) and x in lines[:i] for i, x in enumerate(lines))
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        assert found[:5] == (
            len(tokens),
            len("".join(tokens)),
            symbols,
            repeats,
            covered_by_repeats(tokens),
        )


def test_bands_reject_repetition_and_noise():
    draw = random.Random(2)
    word = lambda: "".join(draw.choice(string.ascii_lowercase) for _ in range(draw.randint(2, 8)))
    prose = " ".join(word() for _ in range(400))
    noise = " ".join("".join(map(chr, draw.choices(range(0x4E00, 0x9FFF), k=9))) for _ in range(300))
    verdict = lambda t: judge(t, QualityRules(), zstandard.ZstdCompressor(level=3))[-1]
    assert verdict(prose)
    assert not verdict(" ".join(f"{w} same words here" for w in ["abc"] * 300))
    assert not verdict(noise)


@pytest.mark.parametrize("size", [300, 400, 500, 700, 1000, 1500, 2000])
def test_bands_reject_short_alphanumeric_noise(size):
    draw = random.Random(size)
    verdict = lambda t: judge(t, QualityRules(min_words=1), zstandard.ZstdCompressor(level=3))[-1]
    for _ in range(50):
        assert not verdict(noise(draw, size))


def noise(draw, size):
    words = ("".join(draw.choices(string.ascii_letters + string.digits, k=draw.randint(3, 9))) for _ in range(size))
    return " ".join(words)[:size]


def test_junk_in_a_long_clean_text_shows():
    draw = random.Random(6)
    known = ["".join(draw.choices(string.ascii_lowercase, k=draw.randint(2, 8))) for _ in range(3000)]
    clean = " ".join(draw.choices(known, k=8000))
    verdict = lambda t: judge(t, QualityRules(), zstandard.ZstdCompressor(level=3))[-1]
    assert verdict(clean)
    assert not verdict(clean[:20_000] + " " + noise(draw, 10_000) + " " + clean[20_000:])


# Secrets


def test_layers_are_unwrapped_and_mapped_back():
    secret = "password=abcdefgh12345"
    inner = base64.b64encode(secret.encode()).decode()
    packed = base64.b64encode(gzip.compress(secret.encode())).decode()
    for hidden in (inner, packed, base64.b64encode(inner.encode()).decode()):
        base, found = find_secrets(f"see {hidden} end")
        assert base == []
        assert found == [(0, 4, 4 + len(hidden))]
    coded = quote(secret, safe="").replace("p", "%70", 1)
    assert find_secrets(f"a {coded} b")[1] == [(0, 2, 2 + len(coded))]
    escaped = "".join(f"\\u{ord(c):04x}" for c in secret)
    assert find_secrets(f"é {escaped} b")[1] == [(0, 2, 2 + len(escaped))]


SECRET = "password=abcdefgh12345"


@pytest.mark.parametrize(
    "content",
    [
        f"log \x1b[31m{SECRET}\x1b[0m end of the line".encode(),
        f"a\x00b {SECRET}".encode(),
        f"caf\xe9 {SECRET} caf\xe9".encode("latin-1"),
        f"wide {SECRET}".encode("utf-16"),
        f"wide {SECRET}".encode("utf-16-be"),
        SECRET.encode(),
    ],
)
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_no_character_hides_a_layer(content, pack):
    hidden = base64.b64encode(pack(content)).decode()
    assert find_secrets(f"see {hidden} end")[1] == [(0, 4, 4 + len(hidden))]


@pytest.mark.parametrize("before, after", [("A", ""), ("ab", ""), ("x/y", ""), ("", "A"), ("Q", "Z")])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_base64_out_of_step(before, after, pack):
    plain = base64.b64encode(pack(f"x {SECRET} with more text".encode())).decode().rstrip("=")
    hidden = before + plain + after
    assert (0, 4, 4 + len(hidden)) in find_secrets(f"see {hidden} end")[1]


def zstd(data):
    return zstandard.ZstdCompressor(write_checksum=True).compress(data)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstd])
@pytest.mark.parametrize("broken", ["checksum", "cut"])
def test_broken_layers_give_what_came(pack, broken):
    """A wrong checksum, or an end that is missing, loses nothing before it."""
    draw = random.Random(3)
    filler = "".join(draw.choices(string.ascii_letters, k=3000))
    text = f"{SECRET} {filler}" if broken == "cut" else f"{filler} {SECRET}"
    data = bytearray(pack(text.encode()))
    if broken == "cut":
        # The one block of this format comes out whole or not at all.
        data = data if pack in (bz2.compress, zstd) else data[: len(data) * 2 // 3]
    else:
        # The check of the content: at the end but for formats with an index behind it.
        at = {bz2.compress: -6, lzma.compress: -33}.get(pack, -3)
        data[at] ^= 0x40
    hidden = base64.b64encode(data).decode()
    assert find_secrets(f"see {hidden} end")[1] == [(0, 4, 4 + len(hidden))]


def test_percent_runs_that_are_not_utf8():
    coded = "%FF%70assword=abcdefgh12345"
    assert find_secrets(f"a {coded} b")[1] == [(0, 5, 2 + len(coded))]


def test_bytes_without_text_are_no_layer():
    draw = random.Random(4)
    noise_runs = [base64.b64encode(draw.randbytes(300)).decode() for _ in range(200)]
    assert find_secrets(" ".join(noise_runs))[1] == []


def brute_base(text):
    """The base spans, matched one place at a time."""
    found = []
    for kind, (pattern, least) in enumerate(
        [
            (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8),
            (r"AKIA[A-Z0-9]+", 16),
            (r"[0-9a-f]+", 32),
        ]
    ):
        rule = re.compile(pattern, (re.IGNORECASE | re.ASCII) if not kind else 0)
        at = 0
        while at < len(text):
            if not (m := rule.match(text, at)):
                at += 1
                continue
            if len(m[2] if not kind else m[0]) >= least:
                found.append((kind, m.start(), m.end()))
            at = m.end()
    return sorted(found)


def test_base_spans_equal_brute_force(documents):
    texts = [r["text"] for r in documents.collect()]
    draw = random.Random(8)
    words = ["password", "Token", "api_key", "apikey", '"', "'", ":", "=", " ", "AKIA", "abcdef0123456789", "Zz9", "\n"]
    texts += ["".join(draw.choices(words, k=30)) for _ in range(300)]
    for text in texts:
        assert sorted(find_secrets(text)[0]) == brute_base(text)


def test_base_matches_are_leftmost_and_filtered():
    text = f"secret=token: abcdefgh12 AKIA{'A' * 11} AKIA{'B' * 12} {HEX} {HEX[:31]}"
    base, found = find_secrets(text)
    assert sorted(k for k, _, _ in base) == [1, 2]
    assert sorted(base) == sorted(found)
    assert listed([(2, 5, 9), (0, 5, 7), (1, 1, 2)]) == "access:1:2,assign:5:7,hex:5:9"


def test_cycles_and_garbage_end():
    assert find_secrets("%25" * 3000)[1] == []
    assert find_secrets("A" * 50_000 + "\\uD83D" * 20 + "\\UFFFFFFFF")[1] == []


def long_text(draw):
    """Text that hardly compresses, with a secret at its end."""
    return "".join(draw.choices(string.ascii_letters + " ", k=300)) + " password=abcdefgh12345"


def test_url_safe_base64_is_one_run():
    draw = random.Random(3)
    for _ in range(100):
        hidden = base64.urlsafe_b64encode(zlib.compress(long_text(draw).encode())).decode()
        assert (0, 4, 4 + len(hidden)) in find_secrets(f"see {hidden} end")[1]


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\n  "])
@pytest.mark.parametrize("before, after", [("", ""), ("see\n", "\nend"), ("data:", " end")])
def test_wrapped_base64_is_one_run(newline, before, after):
    draw = random.Random(4)
    for encode in (base64.b64encode, base64.urlsafe_b64encode):
        for pack in (gzip.compress, lambda data: data):
            coded = encode(pack(long_text(draw).encode())).decode()
            hidden = newline.join(coded[i : i + 76] for i in range(0, len(coded), 76))
            found = find_secrets(before + hidden + after)[1]
            assert (0, len(before), len(before) + len(hidden)) in found


PACKERS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress]


@pytest.mark.parametrize("pack", PACKERS)
def test_all_members_are_read(pack):
    whole = pack(b"first part") + pack("zweiter Teil mit \u00fc ".encode()) + pack(b"password=abcdefgh12345")
    for data in (whole, pack(whole), whole + b"\0\0"):
        hidden = base64.b64encode(data).decode()
        assert find_secrets(f"see {hidden} end")[1] == [(0, 4, 4 + len(hidden))]


def test_long_layers_are_read_to_their_end():
    text = "\u00e9" * 2**25 + "x, password=abcdefgh12345"
    hidden = base64.b64encode(gzip.compress(gzip.compress(text.encode()))).decode()
    assert (0, 4, 4 + len(hidden)) in find_secrets(f"see {hidden} end")[1]


@pytest.mark.parametrize("pack", PACKERS)
@pytest.mark.parametrize("filler", ["\u00e9", "A", "word "])
def test_parts_of_long_layers(monkeypatch, pack, filler):
    for name, size in (("CHUNK", 2**12), ("LONGEST", 2**14), ("OVERLAP", 2**8)):
        monkeypatch.setattr(secrets, name, size)
    text = filler * 20_000 + " password=abcdefgh12345"
    hidden = base64.b64encode(pack(pack(text.encode()))).decode()
    assert (0, 4, 4 + len(hidden)) in find_secrets(f"see {hidden} end")[1]


def test_parts_cut_no_match(monkeypatch):
    draw = random.Random(5)
    monkeypatch.setattr(secrets, "CHUNK", 50)
    for _ in range(200):
        inner = base64.b64encode(b"token: ijklmnop1234").decode()
        words = draw.choices(["ab", "x, y", "12"], k=80) + ["password  =  abcdefgh12345", inner, HEX]
        draw.shuffle(words)
        hidden = base64.b64encode(gzip.compress(" ".join(words).encode())).decode()
        span = (0, len(hidden))
        assert sorted(find_secrets(hidden)[1]) == [(0, *span), (2, *span)]
        pieces = list(secrets.decoded(secrets.plain_bytes(gzip.compress(" ".join(words).encode()))))
        found = [secrets.find_secrets(p)[1] for p in secrets.in_parts(pieces)]
        assert sorted(k for part in found for k, _, _ in part) == [0, 0, 2]


# Surrogates


def test_surrogates_keep_type_format_and_distinctness():
    s = Surrogates(b"key")
    cards = [f"4{n:014d}" for n in range(500)]
    cards = [c + str(luhn(c)) for c in cards]
    new = [s.card(c) for c in cards]
    assert len(set(new)) == len(cards)
    assert all(luhn(c[:-1]) == int(c[-1]) and c[0] == "4" for c in new)
    addresses = {s.ip(f"8.8.{a}.{b}") for a in range(40) for b in range(40)}
    assert len(addresses) == 1600
    iban = s.iban("DE89 3704 0044 0532 0130 00").replace(" ", "")
    assert int(iban[2:4]) == iban_check(iban[:2], iban[4:])
    names = ["Maria", "Anna", "Julia"]
    assert len({s.person(n) for n in names}) == 3
    assert s.person("Анна") != "Анна" and s.person("Анна")[0] > "z"


HIDDEN = [
    ("Mr Ek came", "Ek"),
    ("Mr Äö came", "Äö"),
    ("Señora Íñ vino", "Íñ"),
    ("Mr İbrahim came", "İbrahim"),
    ("Dr Łukasz Nowak came", "Łukasz"),
    ("Dr Łukasz Nowak came", "Nowak"),
    ("Mr Šimon came", "Šimon"),
    ("Mr O'Brien came", "Brien"),
    ("Ms Smith-Jones came", "Smith"),
    ("Ms Smith-Jones came", "Jones"),
    ("Mr Øø came", "Øø"),
    ("MR JOHN SMITH came", "SMITH"),
    ("Alice Brown signed ALICE BROWN", "BROWN"),
    ("host 2001:db8:85a3::8a2e:370:7334 up", "8a2e"),
    ("host fe80::1ff:fe23:4567:890a up", "4567"),
    ("Passport no. X1234567 shown", "X1234567"),
    ("at 12 Baker Hill Street now", "Baker"),
    ("in der Hauptstraße 12a dort", "Haupt"),
    ("born on 1984-03-02 there", "1984-03-02"),
    ("DOB: 13.05.1977 there", "13.05.1977"),
]


@pytest.mark.parametrize("text, value", HIDDEN)
def test_nothing_that_counts_stays(text, value):
    new, *counts, shared = replace_entities(text, Surrogates(b"key"))
    assert value not in new and sum(counts) > 0 and shared == 0
    assert len(new.split()) == len(text.split())


def test_capitals_are_the_same_name():
    new = replace_entities("Mr Brown met BROWN and Brown.", Surrogates(b"key"))[0]
    first, second, third = re.fullmatch(r"Mr (\S+) met (\S+) and (\S+)\.", new).groups()
    assert second == first.upper() and third == first != "Brown"


def test_no_value_is_its_own_surrogate():
    """One ring over all values of a format: none stays, none is shared."""
    s = Surrogates(b"key")
    names = [a + b + c for a in "BDK" for b in "aeiou" for c in "nrt"]
    assert all(s.person(n) != n for n in names) and len({s.person(n) for n in names}) == len(names)
    days = [f"19{y:02d}-{m:02d}-11" for y in range(100) for m in range(1, 13)]
    moved = [s.birth(d) for d in days]
    assert len(set(moved)) == len(days) and not any(a == b for a, b in zip(days, moved))
    assert all(len(m) == 10 and m[:2] == "19" for m in moved)
    two = [s.cipher.permute([i], [7], "t")[0] for i in range(7)]
    assert sorted(two) == list(range(7)) and all(i != v for i, v in enumerate(two))


def test_words_around_colons_are_no_addresses():
    text = "at 12:30:45 std::vector a::b ::1 face::b00c"
    assert replace_entities(text, Surrogates(b"key"))[0] == text


def test_coreference_and_other_keys():
    text = "Call +1 (988) 555-2485, 988-555-2485; bob@a.example.com. Mr Peter Lang came. Lang left."
    new, *counts = replace_entities(text, Surrogates(b"key"))
    digits = [re.sub(r"\D", "", x)[-10:] for x in re.findall(r"[+\d][\d() -]{9,}", new)]
    assert digits[0] == digits[1] != "9885552485"
    assert "bob@" not in new and "555-2485" not in new and "Lang" not in new
    name = re.search(r"Mr \S+ (\S+) came. (\S+) left", new)
    assert name[1] == name[2]
    assert counts[-1] == 0
    assert replace_entities(text, Surrogates(b"other"))[0] != new
    assert replace_entities(text, Surrogates(b"key"))[0] == new


# URLs


def test_rules_and_odd_urls(spark):
    urls = {
        1: ("http://A.Example.NET/en/x", "example.net/en/", "allow"),
        2: ("http://example.net", None, "allow"),
        3: ("http://a.net/", "net/", "block"),
        4: ("http://xnet/", None, "allow"),
        5: ("https://casino-win.example.org/en", None, "block"),
        6: ("https://casino-win.example.org/fr/1?q=/en/", "org/fr/", "allow"),
        7: (None, None, "allow"),
        8: ("no address", None, "allow"),
        9: ("http://example.com/de/1#x", "example.com/de/", "block"),
        10: ("http://notexample.com/de/1", None, "allow"),
    }
    rows = [(i, u, "h", "a rule") for i, (u, _, _) in urls.items()] + [(1, urls[1][0], "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    found = filter_urls(pages, URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["rule"], r["verdict"]) == urls[r["page_id"]][1:], r
    assert filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_url_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = filter_urls(pages, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Rule ensemble


def test_rules_learn_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = score_quality(docs, train_quality(docs, labels)).join(labels, "doc_id")
    rows = scored.filter("held_out").collect()
    assert len(rows) > 40
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93


def test_constant_model_without_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = train_quality(documents, labels)
    assert model.rules == () and model.intercept == 0.0
    assert fit_rules(spark.createDataFrame([(1,)], "label int")).intercept > 0


def test_quality_of_odd_rows(spark, documents, odd, empty):
    """Null, empty, repeated and clashing rows: one score each, equal for equal texts."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    repeated = labels.union(labels.limit(5)).withColumn("text", F.lit("clash"))
    model = train_quality(documents, repeated)
    rows = score_quality(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    scores = {i: {r["score"] for r in rows if r["doc_id"] == i} for i in (1, 2, 5)}
    assert scores[1] == scores[2] and len(scores[5]) == 1
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert score_quality(empty, model).count() == 0
    short = spark.createDataFrame([(1, "x"), (2, "x"), (3, "!"), (4, "7 " * 50_000)], "doc_id long, text string")
    found = [r["score"] for r in score_quality(short, model).orderBy("doc_id").collect()]
    assert found[0] == found[1] and all(0 <= s <= 1 for s in found)


# Edge cases of all


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: quality_rules(d),
        lambda d: scan_secrets(d),
        lambda d: replace_pii(d, PII_KEY),
    ],
)
def test_odd_rows_and_empty_tables(operator, odd, empty):
    assert operator(odd).count() == odd.count()
    assert operator(empty).count() == 0


def test_digest_of_no_spans():
    assert hashlib.sha256(listed([]).encode()).hexdigest().startswith("e3b0c442")
