"""The registered queries of the operators, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape.llm import (
    bpe, cgk, line_dedup, ngram_join, phrases, prefix_trie, quality_rules, quotes, simhash_anchors, simple8b,
    suffix_tree, toxicity, url_filter,
)
from fxtape.llm.url_filter import UrlRule
from fxtape.shared import published


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
]


def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quotes.conversations(table(spark, sf_dir, "conversations"))
    return rows.select(
        F.col("conv").alias("conv_id"), "turn", "thread", "reply_to", "n_passages", "n_linked",
        F.col("deepest").cast("long").alias("deepest"), F.length("clean").cast("long").alias("clean_chars"),
        F.md5("clean").alias("clean_md5"),
    )


def op2_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return simple8b.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encoded(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cgk.searched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filtered(pages, url_filter.link_edges(pages), URL_RULES)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        *[F.col("quality")[c].alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        )],
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scored(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.encoded(table(spark, sf_dir, "conversations"))
    return prefix_trie.tried(prefix_trie.rebuilt(published(turns, "conversation_turns")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_anchors.joined(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quotes": op1_quotes,
    "op2_simple8b": op2_simple8b,
    "op3_bpe": op3_bpe,
    "op4_cgk": op4_cgk,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_quality_rules": op7_quality_rules,
    "op8_ngram_join": op8_ngram_join,
    "op9_suffix_tree": op9_suffix_tree,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_simhash": op13_simhash,
}
def _sql_rule(value: str) -> str:
    """The longest rule that fits, as CASE arms in falling length."""
    ranked = sorted(URL_RULES, key=lambda r: (-len(r.text), r.action != "allow", r.text))
    arms = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{getattr(r, value)}'"
        for r in ranked
    ]
    return f"CASE {' '.join(arms)} END"


_SQL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
_SQL_LOWER = f"translate(%s, '{url_filter.UPPER}', '{url_filter.LOWER}')"


def _sql_part(url: str, n: int) -> str:
    part = f"regexp_extract(coalesce({url}, ''), '{_SQL_PARTS}', {n})"
    return _SQL_LOWER % part if n == 1 else part


def _sql_address(url: str) -> str:
    host = f"regexp_replace({_sql_part(url, 1)}, ':(80|443)$', '')"
    return (
        f"CASE WHEN {_sql_part(url, 1)} <> '' THEN {host} || "
        f"regexp_replace({_sql_part(url, 2)}, '/+$', '') || {_sql_part(url, 3)} END"
    )


# CRC-32 of a number's digits: a step per digit, eight steps per bit shifted out.
_SQL_CRC32 = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(%s::VARCHAR, ''),
  lambda d: [ascii(d), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda s, d: CASE WHEN d >= 0 THEN xor(s, d)
  WHEN s %% 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295)"""

SQL: dict[str, str] = {
    "op6_url_filter": f"""WITH RECURSIVE tags AS (
        SELECT url, regexp_extract(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>', 0) AS tag FROM pages),
      links AS (
        SELECT url, regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1) AS target FROM tags
        WHERE tag <> ''),
      edges AS (SELECT {_sql_address("url")} AS a, {_sql_address("target")} AS b FROM links),
      both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
      own AS (SELECT page_id, {_sql_part("url", 1)} AS host, {_sql_part("url", 2)} AS path,
        {_sql_address("url")} AS node FROM pages),
      ruled AS (SELECT *, {_sql_rule("text")} AS rule, {_sql_rule("action")} AS action FROM own),
      reach(x, y) AS (SELECT a, b FROM both_ways UNION SELECT r.x, e.b FROM reach r JOIN both_ways e ON r.y = e.a),
      aliased AS (SELECT r.x AS node, max(CASE o.action WHEN 'allow' THEN 2 WHEN 'block' THEN 1 END) AS w
        FROM reach r JOIN ruled o ON o.node = r.y GROUP BY 1)
      SELECT page_id, host, path, rule,
        coalesce(action, CASE WHEN w = 1 THEN 'block' ELSE 'allow' END) AS verdict,
        CASE WHEN action IS NOT NULL THEN 'rule' WHEN w IS NOT NULL THEN 'alias' ELSE 'default' END AS source
      FROM ruled LEFT JOIN aliased USING (node)""",
    "op7_quality_rules": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
      w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
      win AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM w, unnest(range(1, len(ws) - 1)) u(i)),
      twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
      rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2]) s(k) GROUP BY 1),
      m AS (SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
        len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
        len(list_filter(ws, lambda x: x IN ({", ".join(repr(x) for x in quality_rules.stop_forms())}))) AS stops
        FROM w LEFT JOIN rep USING (doc_id)),
      b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words
          AND 100 * n_symbols <= 25 * n_words AND 100 * stops >= n_words AND 100 * n_dup_lines <= 50 * n_lines AS kept
      FROM b""",
    "op11_prefix_trie": f"""WITH own AS (SELECT conv_id AS c,
        list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS s
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
      heads AS (SELECT c, s, ({_SQL_CRC32 % "c"} % 4)::BIGINT AS h FROM own),
      built AS (SELECT o.c, list_concat(coalesce(b.s[1:o.h], []), o.s[o.h + 1:]) AS s
        FROM heads o LEFT JOIN own b ON b.c = o.c - o.c % 20),
      steps AS (SELECT c, d, s[1:d] AS p, len(s) AS n FROM built, unnest(range(len(s) + 1)) u(d)),
      node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
        FROM steps GROUP BY p, d),
      child AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
      full_node AS (SELECT node.*, coalesce(child.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE
        (n_convs - 1) * len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) END AS saved
        FROM node LEFT JOIN child USING (p, d)),
      below AS (SELECT p[1:e] AS p, e AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
        sum(saved)::BIGINT AS saved_tokens FROM full_node, unnest(range(d + 1)) u(e) GROUP BY 1, 2)
      SELECT x.conv_id, x.d AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens,
        x.ends_sha256
      FROM full_node x JOIN below USING (p, d) LEFT JOIN node y ON y.p = x.p[1:x.d - 1] AND y.d = x.d - 1""",
    "op12_collocations": f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
        list_filter(regexp_split_to_array(x, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
        FROM documents, unnest(regexp_split_to_array({_SQL_LOWER % "coalesce(text, '')"}, '[.,;:!?\\x0A-\\x0D]')) u(x)),
      total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY 1),
      f AS (SELECT lang, ws[i:i + k - 1] AS w, count(*) AS a
        FROM pieces, unnest([1, 2, 3, 4, 5]) s(k), unnest(range(1, len(ws) - k + 2)) t(i)
        GROUP BY 1, 2 HAVING count(*) >= 100),
      cut AS (SELECT f.lang, f.w, f.a, n, k, x.a AS l, y.a AS r, 1000 * f.a::HUGEINT * n // (x.a::HUGEINT * y.a) AS score
        FROM f JOIN total USING (lang), unnest(range(1, len(f.w))) u(k)
        JOIN f x ON x.lang = f.lang AND x.w = f.w[1:k] JOIN f y ON y.lang = f.lang AND y.w = f.w[k + 1:]),
      lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
      inside AS (SELECT lang, w[i:i + k - 1] AS w, max(a) AS b
        FROM f, unnest(range(2, len(w))) s(k), unnest(range(1, len(w) - k + 2)) t(i) GROUP BY 1, 2),
      ranked AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, n, score::BIGINT AS score,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank
        FROM lowest LEFT JOIN inside USING (lang, w) WHERE b IS NULL OR 100 * b < 100 * a)
      SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
}
