"""Queries over documents, lines, paths and inline texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import extract as X
from quillmill.functions import text as T
from quillmill.operators import corpus
from quillmill.plans.registry import query
from quillmill.plans.tables import table, values

_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r\\x0b\\x0c]+'), lambda x: x <> '')"
_CLEAN = "trim(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g'))"
_PATH = "source || '/' || doc_id || '.txt'"
_ID = f"substr(sha1('node::' || {_PATH}), 1, 16)"


@query("chunk_documents", f"""
WITH w AS (SELECT {_ID} AS source_document_id, doc_id, {_WORDS} AS ws FROM documents),
c AS (SELECT *, CASE WHEN len(ws) = 0 THEN 0 WHEN len(ws) <= 320 THEN 1 ELSE CAST(ceil(len(ws) / 280.0) AS INTEGER) END AS n FROM w),
i AS (SELECT source_document_id, doc_id, ws, unnest(range(0, n)) AS k FROM c)
SELECT source_document_id || '_chunk_' || k AS id, source_document_id, CAST(k AS INTEGER) AS chunk_index, doc_id AS title, array_to_string(ws[k * 280 + 1 : k * 280 + 320], ' ') AS text FROM i
""")
def chunk_documents(spark, sf_dir):
    rows = corpus.document_rows(table(spark, sf_dir, "documents"))
    return corpus.knowledge_chunks(rows).select("id", "source_document_id", "chunk_index", F.col("title").cast("long").alias("title"), "text")


@query("document_rows", f"""
SELECT * FROM (SELECT {_ID} AS id, source AS source_type, {_PATH} AS source_path, {_CLEAN} AS text,
  CASE WHEN len({_WORDS}) < 25 THEN 'low' WHEN len({_WORDS}) < 120 THEN 'medium' ELSE 'high' END AS density FROM documents) WHERE text <> ''
""")
def document_rows(spark, sf_dir):
    return corpus.document_rows(table(spark, sf_dir, "documents")).select("id", "source_type", "source_path", "text", T.density(F.col("text")).alias("density"))


@query("dedupe_lines", """
WITH l AS (SELECT doc_id, i, trim(regexp_replace(regexp_replace(trim(regexp_replace(x, '^\\s+|\\s+$', '', 'g')), '^[•*\\-–—]+\\s*', ''), '\\s+', ' ', 'g'), ' |') AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
f AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY i) AS k FROM l WHERE line <> '')
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS line_index, line FROM f WHERE k = 1
""")
def dedupe_lines(spark, sf_dir):
    return corpus.line_table(table(spark, sf_dir, "documents")).select("doc_id", F.col("line_index").cast("long").alias("line_index"), "line")


@query("first_sentences", """
WITH c AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents),
s AS (SELECT doc_id, CASE WHEN regexp_matches(t, '[.!?] ') THEN regexp_extract(t, '^(.*?[.!?]) ', 1) ELSE t END AS one FROM c)
SELECT doc_id, CASE WHEN length(one) <= 360 THEN one ELSE rtrim(substr(one, 1, 357)) || '...' END AS excerpt FROM s
""")
def first_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.first_sentence(F.col("text")).alias("excerpt"))


_COMMON = {"articles": ("the", "la", "le", "der", "die"), "joining": ("and", "et", "und", "y"), "rude": ("idiot", "moron", "stupid"), "rights": ("license", "copyright")}


#: NFKD folding as SQL can do it: accents go, then what isn't ASCII. Ligatures and fractions would differ; the tests hold those.
_FOLDED = "regexp_replace(strip_accents(coalesce(text, '')), '[^\\x00-\\x7F]', '', 'g')"


def _label_sql(words):
    return f"regexp_matches(low, '(^|[^a-z0-9])({'|'.join(words)})([^a-z0-9]|$)')"


@query("keyword_labels", f"""
SELECT doc_id, coalesce(array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN {_label_sql(w)} THEN '{k}' END" for k, w in _COMMON.items())}], lambda x: x IS NOT NULL)), ','), '') AS labels
FROM (SELECT doc_id, lower({_FOLDED}) AS low FROM documents)
""")
def keyword_labels(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(X.keyword_labels(F.col("text"), _COMMON), ",").alias("labels"))


@query("folded_documents", f"SELECT doc_id, md5({_FOLDED}) AS folded, md5(regexp_replace(lower({_FOLDED}), '[^a-z0-9]+', '', 'g')) AS token, md5(trim(regexp_replace(lower({_FOLDED}), '[^a-z0-9]+', ' ', 'g'))) AS label FROM documents")
def folded_documents(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.fold(text)).alias("folded"), F.md5(T.token(text)).alias("token"), F.md5(T.label(text)).alias("label"))


@query("page_slugs", """
WITH s AS (SELECT page_id, trim(regexp_replace(regexp_replace(trim(replace(url, '\\', '/'), '/'), '[^a-zA-Z0-9/_-]+', '-', 'g'), '-{2,}', '-', 'g'), '-') AS slug FROM pages)
SELECT page_id, slug, substr(sha1('pdf_asset::' || slug || '::1::2'), 1, 16) AS pair_id FROM s
""")
def page_slugs(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))
    return p.withColumn("pair_id", T.pair_id(F.col("slug"), F.lit(1), F.lit(2)))


@query("path_tags", """
SELECT page_id, array_to_string(CASE WHEN len(t) > 6 THEN t[len(t) - 5 :] ELSE t END, '|') AS tags FROM (
  SELECT page_id, list_filter(list_transform(string_split(url, '/'), lambda p: trim(regexp_replace(lower(trim(p)), '[^a-z0-9_-]+', '-', 'g'), '-')), lambda p: p <> '') AS t FROM pages)
""")
def path_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(T.path_tags(F.col("url")), "|").alias("tags"))


@query("part_basenames", """
SELECT p_partkey, s || '__p' || lpad(CAST(p_size AS VARCHAR), 4, '0') || '__a07__' || substr(sha1('pdf_asset::' || pdf || '::' || p_size || '::7'), 1, 16) AS basename FROM (
  SELECT p_partkey, p_size, p_brand || '/' || p_name || '.pdf' AS pdf, replace(trim(regexp_replace(regexp_replace(p_brand || '/' || p_name, '[^a-zA-Z0-9/_-]+', '-', 'g'), '-{2,}', '-', 'g'), '-'), '/', '__') AS s FROM part)
""")
def part_basenames(spark, sf_dir):
    pdf = F.concat("p_brand", F.lit("/"), "p_name", F.lit(".pdf"))
    return table(spark, sf_dir, "part").select("p_partkey", T.pair_basename(pdf, F.col("p_size"), F.lit(7)).alias("basename"))


_LINES = values("id line", [(1, "Page 3 of 9"), (2, "12"), (3, "-----"), (4, "*"), (5, "Stop below 1.25"), (6, "09:30"), (7, "1.2.2024"), (8, "Montag, 3. Juni 2024"), (9, "a"), (10, "  "), (11, "12/14"), (12, "Montag morning")])


@query("noise_lines", f"""
SELECT id, l = '' OR regexp_full_match(l, '(page\\s*)?\\d+(\\s*(/|of)\\s*\\d+)?') OR regexp_full_match(l, '[-_=|. ]{{3,}}') OR regexp_full_match(l, '[^a-z0-9]') AS noise,
  l = '' OR regexp_full_match(l, '\\d{{1,2}}[.:]\\d{{2}}') OR regexp_full_match(l, '\\d{{1,2}}[./-]\\d{{1,2}}[./-]\\d{{2,4}}') OR regexp_full_match(l, '(montag|dienstag|mittwoch|donnerstag|freitag|samstag|sonntag),?\\s+\\d{{1,2}}\\.\\s+\\w+\\s+\\d{{4}}') AS dated
FROM (SELECT id, trim(lower(line)) AS l FROM ({_LINES}))
""")
def noise_lines(spark, sf_dir):
    return spark.sql(_LINES).select("id", T.is_noise(F.col("line")).alias("noise"), T.is_date_or_time(F.col("line")).alias("dated"))


_DIRTY = [(1, "a  b\t\tc"), (2, "one\n\n\n\ntwo  "), (3, "  \n x \n "), (4, "tail\n"), (5, "plain")]


@query("normalize_ws", f"SELECT id, {_CLEAN} AS clean FROM ({values('id text', _DIRTY)})")
def normalize_ws(spark, sf_dir):
    return spark.sql(values("id text", _DIRTY)).select("id", T.normalize_whitespace(F.col("text")).alias("clean"))


_CONTEXT = [(1, "The trend-\nline holds\n• The trendline holds\nPage 2\nentry  |\n---\nEntry"), (2, "One sentence here. Another one! Last"), (3, "09:30\nshort\nA longer heading\n"), (4, "")]


@query("polish_lines")
def polish_lines(spark, sf_dir):
    d = spark.sql(values("id text", _CONTEXT))
    return d.select("id", F.array_join(T.polish(F.col("text")), "|").alias("lines"), T.focus_line(F.col("text")).alias("focus"))


_MARKET = [
    (1, "Bullish on EURUSD 5m, long entry: 1.0850, SL 1.0820 and tp 1.0900"), (2, "No setup today on h4"), (3, "bearish and bullish, buy or sell, setup at 1h ih"), (4, "Stop loss - 99,5 target 120 kauf"),
    (5, "kein Setup, W1 and m15, 15m 1s"), (6, "a quiet page with example and definition of drawdown"), (7, "strategy rules and checklist"), (8, ""), (9, "equity and sharpe, win rate 1d"), (10, "page 4 chart"),
]


def _tf_sql() -> str:
    from quillmill.functions.vocab import TIMEFRAMES

    return "coalesce(array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '\\b({'|'.join(w)})\\b') THEN '{k}' END" for k, w in TIMEFRAMES.items()) + "], lambda x: x IS NOT NULL)), ','), '')"


@query("timeframes", f"SELECT id, {_tf_sql()} AS timeframes FROM ({values('id text', _MARKET)})")
def timeframes(spark, sf_dir):
    return spark.sql(values("id text", _MARKET)).select("id", F.array_join(X.timeframes(F.col("text")), ",").alias("timeframes"))


def _first_sql(patterns, number) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract(text, '(?i){p}{number}', 1), '')" for p in patterns) + ")"


def _levels_sql() -> str:
    from quillmill.functions.vocab import LEVELS, NUMBER

    return ", ".join(f"{_first_sql(p, NUMBER)} AS {k}" for k, p in LEVELS.items())


@query("trade_levels", f"SELECT id, {_levels_sql()} FROM ({values('id text', _MARKET)})")
def trade_levels(spark, sf_dir):
    from quillmill.functions.vocab import LEVELS

    return spark.sql(values("id text", _MARKET)).select("id", *(X.trade_level(F.col("text"), f).alias(f) for f in LEVELS))


def _either(a, wa, b, wb) -> str:
    x, y = (f"regexp_matches(lower(text), '\\b({w})\\b')" for w in (wa, wb))
    return f"CASE WHEN {x} AND NOT {y} THEN '{a}' WHEN {y} AND NOT {x} THEN '{b}' END"


@query("bias_direction", f"""
SELECT id, {_either('bullish', 'bullish|bullisch', 'bearish', 'bearish|bearisch')} AS bias, {_either('long', 'long|buy|kauf', 'short', 'short|sell|verkauf')} AS direction,
  CASE WHEN regexp_matches(lower(text), '\\b(kein|keine[sr]?|no|without|ohne)\\s+setup\\b|\\bkein\\s+signal\\b') THEN 'no_setup' WHEN regexp_matches(lower(text), '\\bsetup\\b') THEN 'setup_mentioned' END AS setup
FROM ({values('id text', _MARKET)})
""")
def bias_direction(spark, sf_dir):
    t = F.col("text")
    return spark.sql(values("id text", _MARKET)).select("id", X.bias(t).alias("bias"), X.direction(t).alias("direction"), X.setup_status(t).alias("setup"))


def _page_sql() -> str:
    from quillmill.functions.vocab import PAGE_TYPES

    score = {k: " + ".join(f"2 * CAST(contains(l, '{w}') AS INTEGER)" for w in ws) for k, ws in PAGE_TYPES.items()}
    score["chart"] += " + m + CAST(contains(l, 'page') AND n < 20 AS INTEGER)"
    score["market_analysis"] += " + m"
    cols = ", ".join(f"{s} AS s_{k}" for k, s in score.items())
    names = [f"s_{k}" for k in PAGE_TYPES]
    pick = " ".join(f"WHEN s_{k} = best THEN '{k}'" for k in PAGE_TYPES)
    return f"""WITH t AS (SELECT id, lower(text) AS l, CAST({_tf_sql()} <> '' AS INTEGER) AS m, len({_WORDS}) AS n FROM ({values('id text', _MARKET)})),
    s AS (SELECT id, {cols} FROM t), b AS (SELECT *, greatest({', '.join(names)}) AS best, {' + '.join(names)} AS total FROM s)
    SELECT id, CASE WHEN best = 0 THEN 'unknown' {pick} END AS page_type, CASE WHEN best = 0 THEN 0.0 ELSE CAST(printf('%.2f', best::DOUBLE / total) AS DOUBLE) END AS confidence FROM b"""


@query("page_types", _page_sql())
def page_types(spark, sf_dir):
    t = F.col("text")
    d = spark.sql(values("id text", _MARKET)).withColumn("p", X.page_type(t, F.array().cast("array<string>"), X.timeframes(t), F.size(T.words(t))))
    return d.select("id", "p.page_type", "p.confidence")


_FUZZY = [(1, "Bitcoin / TetherUS 1h BINANCE"), (2, "bitokn / tetherrus"), (3, "EURUSD and $BTC and SOLUSDT"), (4, "gold against dollars"), (5, "nothing"), (6, "BINANCF chart"), (7, "Ethereum / US Dollar")]


@query("symbols_fuzzy")
def symbols_fuzzy(spark, sf_dir):
    t = F.col("text")
    return spark.sql(values("id text", _FUZZY)).select("id", F.array_join(X.symbols(t), ",").alias("symbols"), F.array_join(X.fuzzy_venues(t), ",").alias("venues"))


@query("asset_types")
def asset_types(spark, sf_dir):
    from quillmill.functions.vocab import DOMAINS

    t, none = F.col("text"), F.array().cast("array<string>")
    return spark.sql(values("id text", _MARKET)).select("id", X.asset_type(t, F.lit(""), none, X.timeframes(t), X.keyword_labels(t), X.keyword_labels(t, DOMAINS)).alias("asset_type"))


@query("fold_tokens")
def fold_tokens(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(T.label(t)).alias("folded"), F.sha1(T.token(t)).alias("token"))


@query("mojibake_repair")
def mojibake_repair(spark, sf_dir):
    d = spark.createDataFrame([(1, "GrÃ¶ÃŸe"), (2, "itâ€™s"), (3, "plain"), (4, "Größe"), (5, None)], "id int, text string")
    return d.select("id", T.punctuation(T.repair(F.col("text"))).alias("text"))
