"""The registered queries of this subpackage, and their check SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.collocations import collocations
from tidemark.llm.decontamination import find_leaks
from tidemark.llm.language_model import score_texts
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_documents
from tidemark.llm.prefix_trie import conversation_trie
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.rule_ensemble import score_quality, train_quality
from tidemark.llm.secrets import scan_secrets
from tidemark.llm.simhash import simhash_components
from tidemark.llm.substring_dedup import dedup_substrings
from tidemark.llm.surrogates import replace_pii
from tidemark.llm.url_filter import ALLOW, BLOCK, filter_urls, in_host, listed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    """Register a query under the name of its function."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rules of the URL query: those its contract lists, and words that spam hosts carry.
URL_RULES = (
    listed("net", "/", BLOCK),
    listed("example.net", "/en/", ALLOW),
    listed("example.com", "/de/", BLOCK),
    listed("org", "/fr/", ALLOW),
    *map(in_host, ("casino", "pills", "poker", "porn", "spam", "viagra", "warez", "xxx")),
)


@query
def op1_secret_scan(spark, sf_dir):
    """Secrets of every document, in the text and below encodings."""
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


@query
def op2_rule_quality(spark, sf_dir):
    """Quality score of every document, from rules learned on labels."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


@query
def op3_benchmark_leaks(spark, sf_dir):
    """Benchmark items found in every document."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_language_model(spark, sf_dir):
    """Base and model scores of every document."""
    return score_texts(table(spark, sf_dir, "documents"))


@query
def op5_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and group of near copies of every document."""
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, distance=4)


@query
def op6_url_filter(spark, sf_dir):
    """Verdict on the URL of every page."""
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLES["op6_url_filter"] = r"""
WITH split AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *,
           CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/')
                    THEN 'example.com/de/'
                WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/')
                    THEN 'example.net/en/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
           END AS rule,
           list_filter(['viagra', 'casino', 'warez', 'poker', 'pills', 'spam', 'porn', 'xxx'],
               lambda w: list_contains(regexp_split_to_array(host, '[.-]'), w)) AS words
    FROM split
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN len(words) > 0 THEN 'block'
            ELSE 'allow' END AS verdict,
       coalesce(rule, '*' || words[1] || '*') AS matched
FROM ruled
"""


@query
def op7_source_mix(spark, sf_dir):
    """What a mix at the sources' weights takes of every document."""
    return mix_sources(table(spark, sf_dir, "documents"))


# The surrogates of the query are the same in every run; a user passes a key of their own.
PII_KEY = b"surrogates of the registered query"


@query
def op8_pii_surrogates(spark, sf_dir):
    """Every document's text with surrogates for personal data."""
    return replace_pii(table(spark, sf_dir, "documents"), PII_KEY)


@query
def op9_quality_rules(spark, sf_dir):
    """Counts, compression ratios and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark, sf_dir):
    """What is left of every document without the windows that an earlier one has."""
    return dedup_substrings(table(spark, sf_dir, "documents"), window=13, digest=True)


ORACLES["op10_substring_dedup"] = r"""
WITH worded AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(words) - 11)) AS pos, words FROM worded WHERE len(words) >= 13
), judged AS (
    SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY array_to_string(words[pos:pos + 12], ' ')) AS first
    FROM windows
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM judged WHERE first < doc_id
), gone AS (
    SELECT doc_id, list(pos) AS places, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(words,
           lambda w, i: places IS NULL OR NOT list_contains(places, i)), ' ')) AS kept_sha256
FROM worded LEFT JOIN gone USING (doc_id)
"""


@query
def op11_collocations(spark, sf_dir):
    """The first 2000 collocations of each language."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), starts AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded
), f AS (
    SELECT lang, words[i:i + k - 1] AS p, count(*) AS f
    FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(k)
    WHERE i + k - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 30
), sizes AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang
), cuts AS (
    SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1
), scored AS (
    SELECT c.lang, c.p, a, l.f AS l, r.f AS r,
           CAST(CAST(a AS HUGEINT) * 2000000 // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
    FROM cuts c JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k]
                JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:]
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.p ORDER BY score, k) = 1
), parts AS (
    SELECT lang, f, p, unnest(range(1, len(p))) AS i FROM f WHERE len(p) > 2
), inner_parts AS (
    SELECT lang, p[i:i + k - 1] AS p, max(f) AS longest FROM parts, (VALUES (2), (3)) AS sizes(k)
    WHERE i + k - 1 <= len(p) AND k < len(p) GROUP BY ALL
), kept AS (
    SELECT s.lang, array_to_string(s.p, ' ') AS phrase, a, l, r, score
    FROM scored s LEFT JOIN inner_parts i ON i.lang = s.lang AND i.p = s.p
    WHERE longest IS NULL OR CAST(longest AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""


@query
def op12_pack_sequences(spark, sf_dir):
    """Pieces of every document, packed into sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op13_conversation_trie(spark, sf_dir):
    """Every distinct start of the conversations, rebuilt with shared first turns."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


ORACLES["op13_conversation_trie"] = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns,
           xor(list_reduce(list_prepend(4294967295, list_transform(
               range(1, length(CAST(conv_id AS VARCHAR)) + 1),
               lambda i: CAST(ord(CAST(conv_id AS VARCHAR)[i]) AS BIGINT))),
               lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                   lambda c, bit: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 9 AS head
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.head], []), c.turns[c.head + 1:]) AS turns
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
), starts AS (
    SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), nodes AS (
    SELECT turns[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
               FILTER (depth = len(turns)), '') AS ends
    FROM starts GROUP BY ALL
), children AS (
    SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY ALL
), own AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(node[depth].text) ELSE 0 END AS saved
    FROM nodes n LEFT JOIN children c USING (node, depth)
), sums AS (
    SELECT x.node, x.depth, count(*) FILTER (y.n_children = 0) AS n_leaves, sum(y.saved) AS saved
    FROM own x JOIN own y ON y.depth >= x.depth AND y.node[1:x.depth] = x.node GROUP BY ALL
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM own o JOIN sums s USING (node, depth)
LEFT JOIN nodes p ON p.depth = o.depth - 1 AND p.node = o.node[1:o.depth - 1]
"""
