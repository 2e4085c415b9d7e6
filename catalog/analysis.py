"""A01-A36."""

from pyspark.sql import functions as F

from catalog.base import TEXT, Tables, joined, postings_sql, query, standard_sql
from corpusgrid.functions import analysis as A
from corpusgrid.functions.stemming import porter_stem, unicode_normalise
from corpusgrid.operators import index as I

STD = standard_sql("text")
LOW = standard_sql()


def numbered(tokens):
    """``pos:term`` list, to show the gaps of removed tokens."""
    return F.array_join(F.transform(tokens, lambda t, i: F.concat(i.cast("string"), F.lit(":"), t)), "|")


def on_text(name: str, tokens_sql: str, analyzer, where: str = "true") -> None:
    """Tokens of every document."""
    @query(name, f"SELECT doc_id, array_to_string({tokens_sql}, '|') AS tokens FROM documents WHERE {where}")
    def _(t: Tables):
        return t.docs.filter(where).select("doc_id", joined(analyzer(F.col("text"))).alias("tokens"))


def each_sql(expression: str, tokens: str = LOW) -> str:
    return f"list_transform({tokens}, lambda t: {expression})"


# --- char filters
@query("a01_cf_mapping", "SELECT doc_id, replace(replace(text, 'ß', 'ss'), 'é', 'e') AS text FROM documents")
def _(t):
    return t.docs.select("doc_id", A.cf_mapping({"ß": "ss", "é": "e"})(F.col("text")).alias("text"))


STRIP_SQL = "html"
for _pattern in ("(?is)<script[^>]*>.*?</script>", "(?is)<style[^>]*>.*?</style>", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
    STRIP_SQL = f"regexp_replace({STRIP_SQL}, '{_pattern}', ' ', 'g')"
for _entity, _char in A.HTML_ENTITIES.items():
    _quoted = _char.replace("'", "''")
    STRIP_SQL = f"replace({STRIP_SQL}, '{_entity}', '{_quoted}')"


@query("a02_cf_html_strip", f"SELECT page_id, {STRIP_SQL} AS text FROM pages")
def _(t):
    return t.pages.select("page_id", A.cf_html_strip(F.col("html")).alias("text"))


# --- tokenizers
on_text("a03_tok_whitespace", r"regexp_extract_all(text, '\S+')", A.tok_whitespace)
on_text("a04_tok_letter", r"regexp_extract_all(text, '\p{L}+')", A.tok_letter)
on_text("a05_tok_lowercase", r"regexp_extract_all(lower(text), '\p{L}+')", A.tok_lowercase)
on_text("a07_tok_standard", STD, A.tok_standard)
UAX = f"{A.EMAIL}|{A.URL}|{A.STANDARD}".replace("'", "''")
on_text("a08_tok_uax_url_email", f"regexp_extract_all(text, '{UAX}')", A.tok_uax_url_email)
on_text("a09_tok_pattern", r"list_filter(regexp_split_to_array(text, '[^a-zA-Z]+'), lambda t: t <> '')", A.tok_pattern("[^a-zA-Z]+"))
on_text("a09_tok_pattern_group", r"regexp_extract_all(text, '[0-9]+')", A.tok_pattern("[0-9]+", group=0))


@query("a06_tok_keyword", "SELECT c_custkey, c_name AS tokens FROM customer")
def _(t):
    return t.customer.select("c_custkey", joined(A.tok_keyword(F.col("c_name"))).alias("tokens"))


def on_names(name: str, tokens_sql: str, analyzer) -> None:
    @query(name, f"SELECT p_partkey, array_to_string({tokens_sql}, '|') AS tokens FROM part")
    def _(t: Tables):
        return t.part.select("p_partkey", joined(analyzer(F.col("p_name"))).alias("tokens"))


def grams_sql(s: str, low: int, high: int) -> str:
    return (f"flatten(list_transform(range(1, greatest(length({s}) - {low} + 2, 1)), lambda i: "
            f"list_transform(range({low}, least({high}, length({s}) - i + 1) + 1), lambda n: substr({s}, i, n))))")


def edges_sql(s: str, low: int, high: int) -> str:
    return f"list_transform(range({low}, least({high}, length({s})) + 1), lambda n: substr({s}, 1, n))"


WORDS_SQL = "string_split(p_name, ' ')"
on_names("a10_tok_ngram", grams_sql("p_name", 2, 3), A.tok_ngram(2, 3))
on_names("a11_tok_edge_ngram", edges_sql("p_name", 1, 10), A.tok_edge_ngram(1, 10))
on_names("a17_tf_ngram", f"flatten(list_transform({WORDS_SQL}, lambda w: {grams_sql('w', 3, 4)}))",
         A.chain(A.tok_whitespace, A.tf_ngram(3, 4)))
on_names("a17_tf_edge_ngram", f"flatten(list_transform({WORDS_SQL}, lambda w: {edges_sql('w', 2, 20)}))",
         A.chain(A.tok_whitespace, A.tf_edge_ngram(2, 20)))


@query("a12_tok_path_hierarchy", r"""SELECT page_id, array_to_string(list_filter(list_transform(range(1, len(parts) + 1),
    lambda n: array_to_string(parts[1:n], '/')), lambda t: t <> ''), '|') AS tokens
    FROM (SELECT page_id, string_split(regexp_extract(url, '^https?://[^/]+([^?#]*)', 1), '/') AS parts FROM pages)""")
def _(t):
    path = F.regexp_extract("url", r"^https?://[^/]+([^?#]*)", 1)
    return t.pages.select("page_id", path.alias("path")).select(
        "page_id", joined(A.tok_path_hierarchy("/")(F.col("path"))).alias("tokens"))


# --- token filters
FOLDED = "t"
for _src, _dst in A.FOLD_PAIRS.items():
    FOLDED = f"replace({FOLDED}, '{_src}', '{_dst}')"
FOLDED = f"translate({FOLDED}, '{A.FOLD_FROM}', '{A.FOLD_TO}')"
on_text("a13_tf_lowercase", each_sql("lower(t)", STD), A.chain(A.tok_standard, A.tf_lowercase))
on_text("a15_tf_asciifolding", each_sql(FOLDED, STD), A.chain(A.tok_standard, A.tf_asciifolding))
on_text("a15_tf_icu_folding", each_sql(f"lower({FOLDED})", STD), A.chain(A.tok_standard, A.tf_icu_folding))
on_text("a16_tf_length", f"list_filter({LOW}, lambda t: length(t) BETWEEN 4 AND 6)", A.chain(TEXT, A.tf_length(4, 6)))
on_text("a22_tf_word_delimiter", r"flatten(list_transform(regexp_extract_all(text, '\S+'), lambda t: "
        r"regexp_extract_all(regexp_replace(t, '[''’]s$', ''), '\p{Lu}*\p{Ll}+|\p{Lu}+|\p{N}+|\p{Lo}+')))",
        A.chain(A.tok_whitespace, A.tf_word_delimiter))
on_text("a23_tf_reverse", each_sql("reverse(t)"), A.chain(TEXT, A.tf_reverse))
on_text("a24_tf_elision", each_sql("regexp_replace(t, '^(?i)(?:l|m|t|qu|n|s|j|d|c)[''’]', '')"), A.chain(TEXT, A.tf_elision()))
on_text("a25_tf_trim", r"list_transform(string_split(text, '.'), lambda t: regexp_replace(t, '^\s+|\s+$', '', 'g'))", A.chain(lambda c: F.split(c, r"\."), A.tf_trim))
on_text("a25_tf_truncate", each_sql("substr(t, 1, 5)"), A.chain(TEXT, A.tf_truncate(5)))
on_text("a26_tf_pattern_replace", each_sql("regexp_replace(t, '[aeiou]+', '_', 'g')"), A.chain(TEXT, A.tf_pattern_replace("[aeiou]+", "_")))
on_text("a21_tf_synonym", f"flatten(list_transform({LOW}, lambda t: CASE t WHEN 'hand' THEN ['palm', 'fist'] WHEN 'only' THEN ['just'] ELSE [t] END))",
        A.chain(TEXT, A.tf_synonym({"hand": ["palm", "fist"], "only": ["just"]})))


@query("a18_tf_shingle", f"""SELECT doc_id, array_to_string(list_transform(list_zip(t[:len(t) - 1], t[2:]), lambda p: p[1] || ' ' || p[2]), '|') AS tokens
    FROM (SELECT doc_id, {LOW} AS t FROM documents)""")
def _(t):
    return t.docs.select("doc_id", joined(A.chain(TEXT, A.tf_shingle(2))(F.col("text"))).alias("tokens"))


@query("a25_tf_unique", f"SELECT doc_id, array_to_string(list_sort(list_distinct({LOW})), '|') AS tokens FROM documents")
def _(t):
    return t.docs.select("doc_id", F.array_join(F.array_sort(A.tf_unique(TEXT(F.col("text")))), "|").alias("tokens"))


STOP_SQL = "(" + ", ".join(f"'{w}'" for w in A.ENGLISH_STOP) + ")"


@query("a14_tf_stop", f"""SELECT doc_id, string_agg(pos || ':' || term, '|' ORDER BY pos) AS tokens FROM (SELECT doc_id, unnest(t) AS term,
    generate_subscripts(t, 1) - 1 AS pos FROM (SELECT doc_id, {LOW} AS t FROM documents)) WHERE term NOT IN {STOP_SQL} GROUP BY doc_id""")
def _(t):
    tokens = A.chain(TEXT, A.tf_stop(A.ENGLISH_STOP))(F.col("text"))
    return t.docs.select("doc_id", numbered(tokens).alias("tokens")).filter("tokens <> ''")


@query("a19_tf_porter_stem")
def _(t):
    """Stems of the whole vocabulary, with the uses counted there."""
    vocab = t.text_index().words("text")
    return vocab.groupBy(porter_stem("term").alias("stem")).agg(F.count(F.lit(1)).alias("terms"), F.sum("cf").alias("uses"))


def soundex_sql(t: str) -> str:
    """First letter, then the codes of the rest: h and w are skipped, equal neighbours are one, vowels part them."""
    rest = f"replace(replace(regexp_replace(substr({t}, 2), '[^a-z]', '0', 'g'), 'h', ''), 'w', '')"
    codes = f"translate({t}[1] || {rest}, 'abcdefghijklmnopqrstuvwxyz', '01230120022455012623010202')"
    for code in "123456":
        codes = f"regexp_replace({codes}, '{code}+', '{code}', 'g')"
    coded = f"upper({t}[1]) || left(replace(substr({codes}, 2), '0', '') || '000', 3)"
    return f"CASE WHEN regexp_matches({t}, '^[a-z]') THEN {coded} ELSE {t} END"


@query("a20_tf_phonetic", f"SELECT doc_id, array_to_string(list_transform({LOW}, lambda t: {soundex_sql('t')}), '|') AS tokens FROM documents")
def _(t):
    return t.docs.select("doc_id", joined(A.chain(TEXT, A.tf_phonetic)(F.col("text"))).alias("tokens"))


@query("a21_synonym_table", f"""SELECT term, count(*) AS uses FROM (
    SELECT coalesce(s.p_name, k.term) AS term FROM (SELECT unnest({LOW}) AS term FROM documents) k
    LEFT JOIN (SELECT DISTINCT lower(p_brand) AS term, p_name FROM part UNION SELECT 'small', p_name FROM part WHERE p_name LIKE 'small%') s
    ON s.term = k.term) GROUP BY term""")
def _(t):
    """Synonym rules as a table of any size: brands and sizes to product names."""
    tokens = I.token_rows(t.docs, TEXT(F.col("text")), "term")
    rules = (t.part.select(F.lower("p_brand").alias("term"), F.col("p_name").alias("synonym"))
             .unionByName(t.part.filter("p_name LIKE 'small%'").select(F.lit("small").alias("term"), F.col("p_name").alias("synonym")))
             .distinct())
    return I.join_synonyms(tokens, rules).groupBy("term").agg(F.count(F.lit(1)).alias("uses"))


@query("a27_tf_icu_normalizer")
def _(t):
    words = t.text_index().words("text").select("term", "df")
    return words.withColumn("norm", unicode_normalise()("term")).groupBy("norm").agg(F.sum("df").alias("df"))


@query("a27_tf_unicode_nfc", f"""WITH {postings_sql()} SELECT nfc_normalize(term) AS norm, sum(df)::BIGINT AS df FROM vocab GROUP BY 1""")
def _(t):
    words = t.text_index().words("text").select("term", "df")
    return words.withColumn("norm", unicode_normalise("NFC", casefold=False)("term")).groupBy("norm").agg(F.sum("df").alias("df"))


@query("a27_tf_icu_collation", f"""SELECT {FOLDED.replace('(t,', '(lower(t),')} AS term, sum(df)::BIGINT AS uses FROM (
    SELECT term AS t, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({STD}) AS term FROM documents) GROUP BY 1) GROUP BY 1""")
def _(t):
    """Case and accents do not count: one row per folded word."""
    words = (I.token_rows(t.docs, A.tok_standard(F.col("text")), "t", "doc_id")
             .groupBy("t").agg(F.countDistinct("doc_id").alias("df")))
    return words.groupBy(F.collate("t", "UNICODE_CI_AI").alias("k")).agg(
        F.min(A.fold(F.lower("t"))).alias("term"), F.sum("df").alias("uses")).select("term", "uses")


@query("a28_tf_dictionary_decompound", f"""WITH words AS (SELECT DISTINCT unnest({LOW}) AS word FROM benchmark),
    vocab AS (SELECT DISTINCT unnest({LOW}) AS term FROM documents)
    SELECT term, word AS part FROM vocab JOIN words ON contains(term, word) AND word <> term""")
def _(t):
    words = I.token_rows(t.benchmark, TEXT(F.col("text")), "word").distinct()
    return I.decompound(t.text_index().words("text"), words).select("term", "part")


# --- analyzers
on_text("a29_analyzer_standard", f"list_filter({LOW}, lambda t: t NOT IN {STOP_SQL})", A.analyzer("standard"))
on_text("a29_analyzer_simple", r"regexp_extract_all(lower(text), '\p{L}+')", A.analyzer("simple"))
on_text("a29_analyzer_whitespace", r"regexp_extract_all(text, '\S+')", A.analyzer("whitespace"))
on_text("a29_analyzer_stop", rf"list_filter(regexp_extract_all(lower(text), '\p{{L}}+'), lambda t: t NOT IN {STOP_SQL})", A.analyzer("stop"))
on_text("a29_analyzer_keyword", "[text]", A.analyzer("keyword"))
on_text("a29_analyzer_pattern", r"list_transform(list_filter(regexp_split_to_array(text, '\W+'), lambda t: t <> ''), lambda t: lower(t))", A.analyzer("pattern"))


@query("a29_analyzer_snowball")
def _(t):
    return t.docs.select("doc_id", joined(A.analyzer("snowball")(F.col("text"))).alias("tokens"))


def language_sql(name: str) -> str:
    words = ", ".join("'" + w + "'" for w in A.STOP_WORDS[name])
    source = LOW
    if name == "french":
        source = f"list_transform({LOW}, lambda t: regexp_replace(t, '^(?i)(?:l|m|t|qu|n|s|j|d|c)[''’]', ''))"
    cases = " ".join(f"WHEN regexp_matches(t, '^{p}') THEN regexp_replace(t, '^{p}', '{r.replace('$', chr(92))}')"
                     for p, r in A.LIGHT_STEM[name])
    return f"list_transform(list_filter({source}, lambda t: t NOT IN ({words})), lambda t: CASE {cases} ELSE t END)"


@query("a30_analyzer_language", "SELECT doc_id, array_to_string(CASE lang " + " ".join(
    f"WHEN '{code}' THEN {language_sql(name)}" for code, name in A.LANG_CODES.items()) + " END, '|') AS tokens FROM documents")
def _(t):
    return t.docs.select("doc_id", joined(A.analyze_by_language(F.col("text"), F.col("lang"))).alias("tokens"))


@query("a31_custom_analyzer", f"""SELECT page_id, array_to_string(list_transform({standard_sql('lower(' + STRIP_SQL + ')')}, lambda t: substr(t, 1, 8)), '|') AS tokens FROM pages""")
def _(t):
    chain = A.custom_analyzer("standard", ["html_strip"], ["lowercase", ("truncate", 8)])
    return t.pages.select("page_id", joined(chain(F.col("html"))).alias("tokens"))


@query("a32_analyze_roles", f"""SELECT conv_id, turn, array_to_string({edges_sql('lower(role)', 1, 10)}, '|') AS stored,
    array_to_string({standard_sql()}, '|') AS searched, array_to_string(regexp_extract_all(text, '\\S+'), '|') AS quoted FROM conversations""")
def _(t):
    chains = {"index": A.chain(F.lower, A.tok_edge_ngram(1, 10)), "search": TEXT, "quote": A.tok_whitespace}
    pick = {r: A.pick_analyzer(r, **chains) for r in ("index", "search", "quote")}
    return t.conversations.select(
        "conv_id", "turn", joined(pick["index"](F.col("role"))).alias("stored"),
        joined(pick["search"](F.col("text"))).alias("searched"), joined(pick["quote"](F.col("text"))).alias("quoted"))


# --- index
@query("a33_build_postings", f"""WITH {postings_sql()}, places AS (SELECT doc_id, term, string_agg(pos, ',' ORDER BY pos) AS positions FROM tok GROUP BY ALL)
    SELECT 'text' AS field, doc_id, term, tf, field_len, positions FROM post JOIN places USING (doc_id, term)
    UNION ALL SELECT 'source', doc_id, source, 1, 1, '0' FROM documents""")
def _(t):
    return I.build_postings(t.docs, "doc_id", {"text": TEXT, "source": "exact", "lang": None}).select(
        "field", "doc_id", "term", F.col("tf").cast("long").alias("tf"), F.col("field_len").cast("long").alias("field_len"),
        F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


@query("a34_term_stats", f"WITH {postings_sql()} SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY term")
def _(t):
    return I.term_stats(I.build_postings(t.docs, "doc_id", {"text": TEXT}, positions=False)).select("term", "df", "cf")


@query("a34_field_stats", f"""WITH {postings_sql()} SELECT 'text' AS field, count(DISTINCT doc_id) AS n_docs, sum(tf)::BIGINT AS n_tokens,
    round(sum(tf) / count(DISTINCT doc_id), 6) AS avg_len FROM post""")
def _(t):
    return I.field_stats(t.text_index().lookup("text"), "doc_id").withColumn("avg_len", F.round("avg_len", 6))


@query("a35_terms_indexed", f"""WITH {postings_sql()} SELECT term, count(*) AS count FROM post WHERE doc_id IN (3, 5, 8)
    GROUP BY term ORDER BY count DESC, term LIMIT 20""")
def _(t):
    return I.terms_indexed(t.text_index(), "text", [3, 5, 8])


def vector_sql(token: str, term: str) -> str:
    """Tokens of a pattern with their places and offsets, from running sums of lengths."""
    return rf"""SELECT doc_id, {term} AS term, pos, (ends - length(term))::INTEGER AS "start", ends::INTEGER AS "end" FROM (
    SELECT doc_id, term, pos, sum(length(span)) OVER (PARTITION BY doc_id ORDER BY pos) AS ends FROM (
    SELECT doc_id, unnest(spans) AS span, unnest(terms) AS term, (generate_subscripts(terms, 1) - 1)::INTEGER AS pos FROM (
    SELECT doc_id, regexp_extract_all(text, '(?s)(.*?)({token})') AS spans, regexp_extract_all(text, '{token}') AS terms FROM documents)))"""


@query("a36_term_vector", vector_sql(r"[\p{L}\p{N}]+(?:[.''][\p{L}\p{N}]+)*", "lower(term)"))
def _(t):
    return I.term_vector(t.docs, "doc_id", "text")


@query("a36_term_vector_whitespace", vector_sql(r"\S+", "term"))
def _(t):
    return I.term_vector(t.docs, "doc_id", "text", A.analyzer("whitespace"))


@query("a36_term_vector_simple", vector_sql(r"\p{L}+", "lower(term)"))
def _(t):
    return I.term_vector(t.docs, "doc_id", "text", A.analyzer("simple"))


