"""Scored queries over ``documents``."""

from pyspark.sql import functions as F

from catalog.base import (LINES_SQL, N_SQL, TEXT, TITLE_SQL, Tables, leaf_sql, norm_sql, postings_sql, query, standard_sql)
from catalog.filters import PEOPLE_SQL, customer_refs, failed_orders
from corpusgrid.functions import analysis as A
from corpusgrid.functions import filters as flt
from corpusgrid.operators import queries as Q
from corpusgrid.operators.elements import fold_elements

POST = postings_sql()


def scores(clause: Q.Clause):
    return clause.scores().drop("qid")


def text(name: str, sql: str | None, make) -> None:
    """A query on the stored index, as ``(doc_id, score)``."""
    @query(name, sql)
    def _(t: Tables):
        return scores(make(t.text_index()))


def simple(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([POST, *ctes])} {body}"


def match_sql(terms, need=1, coord=True, boosts=None) -> str:
    return simple(f"SELECT doc_id, round(s * {norm_sql(1)}, 6) AS score FROM c1", leaf_sql(1, terms, need, coord, boosts=boosts))


text("q01_match", match_sql(["attion", "hand", "only"]), lambda i: Q.match(i, "text", "attion hand ONLY"))
text("q01_match_and", match_sql(["the", "hand"], need=2), lambda i: Q.match(i, "text", "the hand", operator="and"))
text("q01_match_minimum", match_sql(["attion", "hand", "only", "zzzzabsent"], need=2),
     lambda i: Q.match(i, "text", "attion hand only zzzzabsent", minimum_should_match="50%"))

EVERYWHERE = postings_sql(expression="concat_ws(' ', lang, source, text)")


@query("q01_match_anywhere", f"WITH {EVERYWHERE}, {leaf_sql(1, ['en', 'hand', 'only'])} SELECT doc_id, round(s * {norm_sql(1)}, 6) AS score FROM c1")
def _(t):
    """No field: any of language, source and text."""
    return scores(Q.anywhere(t.all_index(), "EN hand only"))


@query("q01_match_anywhere_and", f"WITH {EVERYWHERE}, {leaf_sql(1, ['en', 'hand'], 2)} SELECT doc_id, round(s * {norm_sql(1)}, 6) AS score FROM c1")
def _(t):
    """Both words, which may stand in different fields."""
    return scores(Q.anywhere(t.all_index(), "en hand", operator="and"))


BATCH = f"""{POST},
    q AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+(?:[.''][\\p{{L}}\\p{{N}}]+)*')) AS term FROM benchmark),
    w AS (SELECT q.item_id, q.term, 1 + ln({N_SQL} / (coalesce(df, 0) + 1)) AS idf FROM q LEFT JOIN vocab v ON v.term = q.term),
    n AS (SELECT item_id, count(*) AS n_terms, 1 / sqrt(sum(idf * idf)) AS qnorm FROM w GROUP BY item_id)"""


SCORED = """SELECT w.item_id, p.doc_id,
    round(sum(sqrt(p.tf) / sqrt(p.field_len) * w.idf * w.idf) * any_value(n.qnorm) * count(*) / any_value(n.n_terms), 6) AS score
    FROM post p JOIN w ON w.term = p.term JOIN n ON n.item_id = w.item_id GROUP BY w.item_id, p.doc_id"""
PAGE = "QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"


def asked(t: Tables):
    """Every benchmark text as a query."""
    return t.benchmark.select(F.col("item_id").alias("qid"), "text")


def page(clause: Q.Clause):
    """The ten best documents of each query of a table."""
    return clause.best(10).drop("rank").withColumnRenamed("qid", "item_id")


@query("q01_match_batch", f"WITH {BATCH} SELECT * FROM ({SCORED}) {PAGE}")
def _(t):
    return page(Q.match(t.text_index(), "text", asked(t)))


# One byte per letter, so that the byte-wise distance counts letters.
LETTERS, BYTES = "àâäáçéèêëîïíôöóùûüúñßœæ", "ABCDEFGHIJKLMNOPQRSTUVW"


def plain_sql(c: str) -> str:
    return f"translate({c}, '{LETTERS}', '{BYTES}')"


WORDS_SQL = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+(?:[.''][\\p{L}\\p{N}]+)*')"


@query("q01_match_batch_fuzzy", f"""WITH {POST}, q AS (SELECT item_id, unnest(s) AS seed, generate_subscripts(s, 1) AS ord FROM (SELECT item_id, {WORDS_SQL} AS s FROM benchmark)),
    b AS (SELECT DISTINCT seed, {plain_sql('seed')} AS sl, length(seed) AS n FROM q),
    near AS (SELECT seed, term, df, 1 - levenshtein(sl, tl) / b.n::DOUBLE AS boost FROM b
        JOIN (SELECT term, df, {plain_sql('term')} AS tl, unnest([length(term) - 1, length(term), length(term) + 1]) AS m FROM vocab) v ON v.m = b.n AND levenshtein(sl, tl) <= 1),
    w AS (SELECT item_id, ord, term, boost, 1 + ln({N_SQL} / (df + 1)) AS idf FROM q JOIN near USING (seed)),
    n AS (SELECT item_id, count(DISTINCT ord) AS n_terms FROM q GROUP BY item_id),
    m AS (SELECT item_id, 1 / sqrt(sum(idf * boost * idf * boost)) AS qnorm FROM w GROUP BY item_id),
    words AS (SELECT item_id, ord, doc_id, sum(sqrt(tf) / sqrt(field_len) * idf * idf * boost) AS s FROM post JOIN w USING (term) GROUP BY ALL)
    SELECT item_id, doc_id, round(sum(s) * any_value(qnorm) * count(*) / any_value(n_terms), 6) AS score
    FROM words JOIN n USING (item_id) JOIN m USING (item_id) GROUP BY item_id, doc_id {PAGE}""")
def _(t):
    """Every word of every query widened to terms within one edit."""
    return page(Q.match(t.text_index(), "text", asked(t), fuzziness=1))


@query("q15_bool_batch", f"""WITH {BATCH}, m AS ({SCORED.replace('round(', '(').replace(', 6)', ')')}), x AS (SELECT DISTINCT doc_id FROM post WHERE term LIKE 'thaned%'),
    y AS (SELECT DISTINCT doc_id FROM post WHERE term = 'tionsh')
    SELECT * FROM (SELECT item_id, doc_id, round((score + 1) * 2 / 2, 6) AS score FROM m WHERE doc_id IN (FROM x) AND doc_id NOT IN (FROM y)) {PAGE}""")
def _(t):
    """A table of queries beside clauses that hold for all of them."""
    i = t.text_index()
    return page(Q.bool_(must=[Q.match(i, "text", asked(t)), Q.prefix(i, "text", "thaned")], must_not=[Q.term(i, "text", "tionsh")]))


@query("q17_boosting_batch", f"""WITH {BATCH}, m AS ({SCORED.replace('round(', '(').replace(', 6)', ')')})
    SELECT * FROM (SELECT item_id, doc_id, round(score * CASE WHEN doc_id IN (SELECT doc_id FROM post WHERE term = 'the') THEN 0.2::DOUBLE ELSE 1 END, 6) AS score
        FROM m) {PAGE}""")
def _(t):
    i = t.text_index()
    return page(Q.boosting(Q.match(i, "text", asked(t)), Q.term(i, "text", "the"), 0.2))


def not_sql(*terms: str) -> str:
    listed = ", ".join(f"'{x}'" for x in terms)
    return simple(f"SELECT doc_id, 1.0::DOUBLE AS score FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM post WHERE term IN ({listed}))")


text("q02_not_match", not_sql("the", "hand"), lambda i: Q.not_(Q.match(i, "text", "the hand"), i.docs))

# --- several fields
TWO = f"WITH {POST}, {postings_sql('title', TITLE_SQL, '_t')}, {leaf_sql(1, ['attion', 'the'])}, {leaf_sql(2, ['attion', 'the'], name='_t', boosts=[2, 2])}"
PARTS = f"SELECT doc_id, s * {norm_sql(1, 2)} AS s FROM (SELECT * FROM c1 UNION ALL SELECT * FROM c2)"
text("q03_multi_match_dis_max", f"{TWO} SELECT doc_id, round(max(s) + 0.3 * (sum(s) - max(s)), 6) AS score FROM ({PARTS}) GROUP BY doc_id",
     lambda i: Q.multi_match(i, ["text", "title^2"], "attion the", tie_breaker=0.3))
text("q03_multi_match_sum", f"{TWO} SELECT doc_id, round(sum(s) * count(*) / 2, 6) AS score FROM ({PARTS}) GROUP BY doc_id",
     lambda i: Q.multi_match(i, ["text", "title^2"], "attion the", use_dis_max=False))


# --- phrases
def phrase_ctes(n: int, words: list, slop: int = 0, tail: str | None = None, name: str = "") -> str:
    """CTE ``c<n>`` (doc_id, s) and ``w<n>`` of a phrase; ``tail`` is a prefix.

    A word is at the next place, or a pair (place, word).
    """
    slots = [w if isinstance(w, tuple) else (i, w) for i, w in enumerate(words)]
    rows = [f"SELECT {i} AS ord, '{w}' AS term" for i, w in slots]
    if tail is not None:
        rows.append(f"SELECT {len(words)} AS ord, term FROM vocab{name} WHERE term LIKE '{tail}%'")
    k = len({i for i, _ in slots}) + (tail is not None)
    return f"""
    g{n} AS ({' UNION ALL '.join(rows)}),
    i{n} AS (SELECT sum(1 + ln({N_SQL} / (coalesce(df, 0) + 1))) AS idf FROM g{n} LEFT JOIN vocab{name} v ON v.term = g{n}.term),
    w{n} AS (SELECT idf, 1.0 AS boost FROM i{n}),
    s{n} AS (SELECT DISTINCT doc_id, ord, pos - ord AS start, field_len FROM tok{name} JOIN g{n} ON tok{name}.term = g{n}.term),
    a{n} AS (SELECT DISTINCT doc_id, start FROM s{n}),
    m{n} AS (SELECT a.doc_id, a.start, s.ord, min(s.start) AS reach, any_value(field_len) AS field_len FROM a{n} a JOIN s{n} s
        ON s.doc_id = a.doc_id AND s.start BETWEEN a.start AND a.start + {slop} GROUP BY ALL),
    d{n} AS (SELECT doc_id, start, max(reach) - start AS d, any_value(field_len) AS field_len FROM m{n} GROUP BY doc_id, start HAVING count(*) = {k}),
    c{n} AS (SELECT doc_id, sqrt(sum(1.0 / (1 + d))) * idf * idf / sqrt(any_value(field_len)) AS s FROM d{n}, i{n} GROUP BY doc_id, idf)"""


def phrase_sql(words, slop=0, tail=None) -> str:
    return simple(f"SELECT doc_id, round(s * {norm_sql(1)}, 6) AS score FROM c1", phrase_ctes(1, words, slop, tail))


text("q04_phrase", phrase_sql(["of", "the"]), lambda i: Q.match_phrase(i, "text", "of the"))
text("q04_phrase_slop", phrase_sql(["the", "of", "and"], 3), lambda i: Q.match_phrase(i, "text", "the of and", slop=3))
text("q04_not_phrase", simple("SELECT doc_id, 1.0::DOUBLE AS score FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM c1)", phrase_ctes(1, ["of", "the"])),
     lambda i: Q.not_(Q.match_phrase(i, "text", "of the"), i.docs))
text("q05_phrase_prefix", phrase_sql(["of"], 0, "th"), lambda i: Q.match_phrase_prefix(i, "text", "of th"))



def phrase_batch_sql(slop: int = 0, prefix: bool = False) -> str:
    """Every benchmark text as a phrase, whose last word may be a prefix."""
    more = "UNION SELECT item_id, ord, v.term FROM q JOIN k USING (item_id) JOIN vocab v ON starts_with(v.term, q.term) WHERE ord = n"
    return f"""WITH {POST},
    q AS (SELECT item_id, unnest(s) AS term, generate_subscripts(s, 1) AS ord FROM (SELECT item_id, {WORDS_SQL} AS s FROM benchmark)),
    k AS (SELECT item_id, max(ord) AS n FROM q GROUP BY item_id),
    g AS (SELECT item_id, ord, term FROM q {f"JOIN k USING (item_id) WHERE ord < n {more}" if prefix else ""}),
    i AS (SELECT item_id, sum(1 + ln({N_SQL} / (coalesce(df, 0) + 1))) AS idf FROM g LEFT JOIN vocab v ON v.term = g.term GROUP BY item_id),
    h AS (SELECT item_id, doc_id FROM g JOIN post USING (term) JOIN k USING (item_id) GROUP BY item_id, doc_id, n HAVING count(DISTINCT ord) = n),
    s AS (SELECT DISTINCT item_id, doc_id, ord, pos - ord AS start, field_len FROM g JOIN tok USING (term) JOIN h USING (item_id, doc_id)),
    a AS (SELECT DISTINCT item_id, doc_id, start FROM s),
    m AS (SELECT a.item_id, a.doc_id, a.start, s.ord, min(s.start) AS reach, any_value(field_len) AS field_len FROM a JOIN s
        ON s.item_id = a.item_id AND s.doc_id = a.doc_id AND s.start BETWEEN a.start AND a.start + {slop} GROUP BY ALL),
    d AS (SELECT item_id, doc_id, start, max(reach) - start AS d, any_value(field_len) AS field_len FROM m JOIN k USING (item_id)
        GROUP BY item_id, doc_id, start, n HAVING count(*) = n)
    SELECT item_id, doc_id, round(sqrt(sum(1.0 / (1 + d))) * idf / sqrt(any_value(field_len)), 6) AS score
    FROM d JOIN i USING (item_id) GROUP BY item_id, doc_id, idf {PAGE}"""


@query("q04_phrase_batch", phrase_batch_sql())
def _(t):
    return page(Q.match_phrase(t.text_index(), "text", asked(t)))


@query("q04_phrase_batch_slop", phrase_batch_sql(2))
def _(t):
    return page(Q.match_phrase(t.text_index(), "text", asked(t), slop=2))


@query("q05_phrase_prefix_batch", phrase_batch_sql(prefix=True))
def _(t):
    return page(Q.match_phrase_prefix(t.text_index(), "text", asked(t)))


STOPPED = f"""{POST}, tok_s AS (SELECT doc_id, term, pos, count(*) OVER (PARTITION BY doc_id) AS field_len FROM tok
        WHERE term NOT IN ({", ".join(f"'{w}'" for w in A.ENGLISH_STOP)})),
    vocab_s AS (SELECT term, count(DISTINCT doc_id) AS df FROM tok_s GROUP BY term)"""
SYNONYMS = {"the": ["the", "le"], "of": ["of", "palm", "fist"]}
WIDENED = f"""{POST}, more AS (SELECT * FROM (VALUES ('the', 'le'), ('of', 'palm'), ('of', 'fist')) m(term, other)),
    all_y AS (SELECT doc_id, term, pos FROM tok UNION ALL SELECT doc_id, other, pos FROM tok JOIN more USING (term)),
    tok_y AS (SELECT doc_id, term, pos, count(*) OVER (PARTITION BY doc_id) AS field_len FROM all_y),
    vocab_y AS (SELECT term, count(DISTINCT doc_id) AS df FROM tok_y GROUP BY term)"""


def phrase_over(name: str, ctes: str, words: list, suffix: str, phrase: str, analyzer, slop: int = 0) -> None:
    """A phrase over the text indexed with another analyzer."""
    @query(name, f"WITH {ctes}, {phrase_ctes(1, words, slop, name=suffix)} SELECT doc_id, round(s * {norm_sql(1)}, 6) AS score FROM c1")
    def _(t):
        index = t._index(f"documents{suffix}", lambda: t.documents.select("doc_id", "text"), "doc_id", {"text": analyzer})
        return scores(Q.match_phrase(index, "text", phrase, slop))


phrase_over("q04_phrase_removed_words", STOPPED, [(0, "er"), (2, "en")], "_s", "er of en", A.analyzer("standard"))
phrase_over("q04_phrase_removed_words_slop", STOPPED, [(0, "er"), (3, "en")], "_s", "er of the en", A.analyzer("standard"), 2)
phrase_over("q04_phrase_synonyms", WIDENED, [(0, "of"), (0, "palm"), (0, "fist"), (1, "the"), (1, "le")], "_y", "of the",
            A.custom_analyzer("standard", filters=["lowercase", ("synonym", SYNONYMS)]))
phrase_over("q04_phrase_quote_analyzer", WIDENED, [(0, "palm"), (1, "le")], "_y", "PALM le", {
    "index": A.custom_analyzer("standard", filters=["lowercase", ("synonym", SYNONYMS)]), "quote": TEXT, "search": A.tok_whitespace})


@query("q04_phrase_of_removed_words", f"""WITH {STOPPED}, w AS (SELECT 1 + ln({N_SQL} / (df + 1)) AS idf FROM vocab_s WHERE term = 'er')
    SELECT doc_id, round(sqrt(count(*)) / sqrt(any_value(field_len)) * any_value(idf) / 3, 6) AS score FROM tok_s, w WHERE term = 'er' GROUP BY doc_id""")
def _(t):
    """Texts of removed words alone find nothing, but count as clauses."""
    index = t._index("documents_s", lambda: t.documents.select("doc_id", "text"), "doc_id", {"text": A.analyzer("standard")})
    return scores(Q.bool_(should=[Q.match(index, "text", "er"), Q.match(index, "text", "of the"), Q.match_phrase(index, "text", "to the")]))


# --- terms
text("q06_term", match_sql(["hand"], boosts=[3]), lambda i: Q.term(i, "text", "hand", boost=3))
text("q06_not_term", not_sql("hand"), lambda i: Q.not_(Q.term(i, "text", "hand"), i.docs))
text("q07_terms", match_sql(["hand", "only", "attion", "then"], need=2), lambda i: Q.terms(i, "text", ["hand", "only", "attion", "then"], 2))


def any_term(name: str, test: str, make, boost: float = 1.0) -> None:
    text(name, simple(f"SELECT DISTINCT doc_id, {boost}::DOUBLE AS score FROM post WHERE {test}"), make)


any_term("q08_prefix", "term LIKE 'thaned%'", lambda i: Q.prefix(i, "text", "thaned", 2.5), 2.5)
any_term("q09_wildcard", "regexp_matches(term, '^th.n.*e$')", lambda i: Q.wildcard(i, "text", "th?n*e"))
any_term("q09_wildcard_middle", "term LIKE '%ttio%'", lambda i: Q.wildcard(i, "text", "*ttio*"))
any_term("q09_wildcard_end", "term LIKE '%er_nd'", lambda i: Q.wildcard(i, "text", "*er?nd"))

EDITS = "levenshtein('attion', regexp_replace(term, '[^\\x00-\\x7f]', '#', 'g'))"
FUZZY_SQL = f"""WITH {POST}, near AS (SELECT term, {EDITS} AS edits FROM vocab WHERE {EDITS} <= 2),
    w1 AS (SELECT near.term, 1 - edits / 6.0::DOUBLE AS boost, 1 + ln({N_SQL} / (df + 1)) AS idf FROM near JOIN vocab v ON v.term = near.term)
    SELECT doc_id, round(sum(sqrt(tf) / sqrt(field_len) * idf * idf * boost) * {norm_sql(1)}, 6) AS score
    FROM post JOIN w1 ON w1.term = post.term GROUP BY doc_id"""
text("q10_fuzzy", FUZZY_SQL, lambda i: Q.fuzzy(i, "text", "attion", 2))


def with_deletions(i):
    """The index, with the deletions of its terms stored."""
    return i if i.deletions is not None else None


text("q10_fuzzy_stored", FUZZY_SQL, lambda i: Q.fuzzy(with_deletions(i), "text", "attion", 2))
text("q10_fuzzy_prefix", f"""WITH {POST}, near AS (SELECT term, {EDITS} AS edits FROM vocab WHERE term LIKE 'a%' AND {EDITS} <= 2 ORDER BY edits, term LIMIT 20),
    w1 AS (SELECT near.term, 1 - edits / 6.0::DOUBLE AS boost, 1 + ln({N_SQL} / (df + 1)) AS idf FROM near JOIN vocab v ON v.term = near.term)
    SELECT doc_id, round(sum(sqrt(tf) / sqrt(field_len) * idf * idf * boost) * {norm_sql(1)}, 6) AS score
    FROM post JOIN w1 ON w1.term = post.term GROUP BY doc_id""", lambda i: Q.fuzzy(i, "text", "attion", 2, prefix_length=1, max_expansions=20))


@query("q11_range", "SELECT o_orderkey, 2.0::DOUBLE AS score FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 200000")
def _(t):
    return scores(Q.range_(t.orders, "o_orderkey", "o_totalprice", 2.0, from_=100000, to=200000, include_upper=False))


# --- like this
LIKE = f"""{POST},
    seed AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text),
        '[\\p{{L}}\\p{{N}}]+(?:[.''][\\p{{L}}\\p{{N}}]+)*')) AS term FROM benchmark) GROUP BY ALL),
    rated AS (SELECT item_id, seed.term, tf, 1 + ln({N_SQL} / (df + 1)) AS idf, df FROM seed JOIN vocab v ON v.term = seed.term)"""


def like_sql(picked: str, need: str, coord: str) -> str:
    return f"""WITH {LIKE}, {picked},
    n AS (SELECT item_id, count(*) AS n_terms, 1 / sqrt(sum((idf * boost) * (idf * boost))) AS qnorm FROM w GROUP BY item_id)
    SELECT * FROM (SELECT w.item_id, p.doc_id, round(sum(sqrt(p.tf) / sqrt(p.field_len) * w.idf * w.idf * w.boost) * any_value(n.qnorm) {coord}, 6) AS score
    FROM post p JOIN w ON w.term = p.term JOIN n ON n.item_id = w.item_id GROUP BY w.item_id, p.doc_id HAVING count(*) >= {need}) {PAGE}"""


@query("q12_more_like_this", like_sql("w AS (SELECT item_id, term, idf, 1.0::DOUBLE AS boost FROM rated)",
    "greatest(floor(any_value(n.n_terms) * 0.3::DOUBLE), 1)", "* count(*) / any_value(n.n_terms)"))
def _(t):
    return page(Q.more_like_this(t.text_index(), "text", asked(t), 0.3))


@query("q12_more_like_this_selected", like_sql("""w AS (SELECT item_id, term, idf, 1.0::DOUBLE AS boost FROM rated WHERE df >= 5 AND length(term) >= 3
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(tf * idf, 6) DESC, term) <= 25)""",
    "greatest(floor(any_value(n.n_terms) * 0.3::DOUBLE), 1)", "* count(*) / any_value(n.n_terms)"))
def _(t):
    """The request narrows the terms."""
    return page(Q.more_like_this(t.text_index(), "text", asked(t), 0.3, min_word_len=3, min_doc_freq=5, max_query_terms=25))


@query("q13_fuzzy_like_this", like_sql(f"""b AS (SELECT DISTINCT term AS seed, {plain_sql('term')} AS sl, length(term) AS n FROM rated),
    v2 AS (SELECT term, df, {plain_sql('term')} AS tl, length(term) AS n FROM vocab),
    near AS (SELECT seed, term, df, 1 - levenshtein(sl, tl) / b.n::DOUBLE AS share FROM b JOIN (SELECT *, unnest([n - 1, n, n + 1]) AS m FROM v2) v
        ON v.m = b.n AND levenshtein(sl, tl) <= 1),
    w AS (SELECT item_id, near.term, 1 + ln({N_SQL} / (any_value(near.df) + 1)) AS idf, max(share * sqrt(tf)) AS boost
    FROM rated JOIN near ON near.seed = rated.term GROUP BY item_id, near.term)""", "1", ""))
def _(t):
    return page(Q.fuzzy_like_this(t.text_index(), "text", asked(t), 1))


# --- combinations
def tagged(*roles: str) -> str:
    return " UNION ALL ".join(f"SELECT doc_id, s, '{r}' AS role FROM c{i}" for i, r in enumerate(roles, 1))


def bool_sql(roles: list[str], ctes: list[str], least: int, norm: str, coord: bool = True) -> str:
    total = sum(r != "not" for r in roles)
    factor = f"* count(*) FILTER (role <> 'not') / {total}" if coord else ""
    return simple(f"""SELECT doc_id, round(sum(s) FILTER (role <> 'not') * {norm} {factor}, 6) AS score FROM ({tagged(*roles)}) GROUP BY doc_id
    HAVING count(*) FILTER (role = 'must') = {roles.count('must')} AND count(*) FILTER (role = 'should') >= {least} AND count(*) FILTER (role = 'not') = 0""", *ctes)


def bool_parts(i):
    return {"must": [Q.match(i, "text", "the")], "should": [Q.match(i, "text", "hand only"), Q.term(i, "text", "attion", 2)],
            "must_not": [Q.match(i, "text", "tionsh")]}


BOOL = [leaf_sql(1, ["the"]), leaf_sql(2, ["hand", "only"]), leaf_sql(3, ["attion"], boosts=[2]), leaf_sql(4, ["tionsh"])]
ROLES = ["must", "should", "should", "not"]
text("q15_bool", bool_sql(ROLES, BOOL, 0, norm_sql(1, 2, 3)), lambda i: Q.bool_(**bool_parts(i)))
text("q15_bool_minimum", bool_sql(ROLES, BOOL, 1, norm_sql(1, 2, 3), coord=False),
     lambda i: Q.bool_(**bool_parts(i), minimum_should_match=1, disable_coord=True))
text("q15_not_bool", simple(f"SELECT doc_id, 1.0::DOUBLE AS score FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM c1)", leaf_sql(1, ["the"])),
     lambda i: Q.bool_(must_not=[Q.match(i, "text", "the")], docs=i.docs))
text("q14_text_query", bool_sql(["must", "should", "should", "should", "not"], [
    leaf_sql(1, ["the"]), leaf_sql(2, ["hand"]), leaf_sql(3, ["only"]), phrase_ctes(4, ["of", "the"]), leaf_sql(5, ["tionsh"])], 1, norm_sql(1, 2, 3, 4)),
    lambda i: Q.text_query(i, ["text"], required="the", optional="hand only", phrases=["of the"], prohibited="tionsh", minimum_should_match=1))
text("q16_dis_max", simple(f"""SELECT doc_id, round((max(s) + 0.4 * (sum(s) - max(s))) * {norm_sql(1, 2)}, 6) AS score
    FROM ({tagged('a', 'a')}) GROUP BY doc_id""", leaf_sql(1, ["hand", "the"]), leaf_sql(2, ["attion"])),
    lambda i: Q.dis_max([Q.match(i, "text", "hand the"), Q.term(i, "text", "attion")], 0.4))

THE = simple("SELECT {0} FROM c1 JOIN documents USING (doc_id)", leaf_sql(1, ["the", "hand"]))
NORMED = f"(s * {norm_sql(1)})"


def the(i):
    return Q.match(i, "text", "the hand")


def one(name: str, columns: str, make, where: str = "") -> None:
    text(name, THE.replace("{0}", f"doc_id, {columns} AS score") + where, make)


one("q17_boosting", f"round({NORMED} * CASE WHEN doc_id IN (SELECT doc_id FROM post WHERE term = 'attion') THEN 0.2::DOUBLE ELSE 1 END, 6)",
    lambda i: Q.boosting(the(i), Q.term(i, "text", "attion"), 0.2))
one("q18_custom_boost", f"round({NORMED} * 5, 6)", lambda i: Q.custom_boost(the(i), 5))
one("q19_custom_score", f"round({NORMED} * ln(2 + n_chars) / 3, 6)",
    lambda i: Q.custom_score(the(i), i.docs, "_score * ln(2 + n_chars) / :divisor", divisor=3))


def factors(i):
    return [(F.col("lang") == "en", 2), (F.col("n_chars") > 3000, 3), (F.col("source") == "src3", F.col("n_chars") / 100)]


FACTORS = "[x FOR x IN [CASE WHEN lang = 'en' THEN 2.0::DOUBLE END, CASE WHEN n_chars > 3000 THEN 3.0::DOUBLE END, CASE WHEN source = 'src3' THEN n_chars / 100.0::DOUBLE END] IF x IS NOT NULL]"
for _mode, _fold in {"first": "f[1]", "min": "list_min(f)", "max": "list_max(f)", "total": "list_sum(f)", "avg": "list_avg(f)", "multiply": "list_product(f)"}.items():
    _value = _fold.replace("(f)", f"({FACTORS})").replace("f[1]", f"({FACTORS})[1]")
    _factor = f"least(CASE WHEN len({FACTORS}) = 0 THEN 1.0::DOUBLE ELSE {_value} END, 40.0::DOUBLE)"
    one(f"q20_custom_filters_score_{_mode}", f"round({NORMED} * {_factor}, 6)",
        lambda i, m=_mode: Q.custom_filters_score(the(i), i.docs, factors(i), m, max_boost=40))

text("q21_constant_score", "SELECT doc_id, 1.5::DOUBLE AS score FROM documents WHERE lang = 'fr'",
     lambda i: Q.constant_score(i.docs, "doc_id", F.col("lang") == "fr", 1.5))
one("q22_filtered", f"round({NORMED}, 6)", lambda i: Q.filtered(the(i), i.docs, F.col("lang") == "en"), " WHERE lang = 'en'")
text("f22_query_as_filter", simple("SELECT doc_id, 1.0::DOUBLE AS score FROM documents WHERE doc_id IN (SELECT doc_id FROM c1)", leaf_sql(1, ["the", "hand"], 2)),
     lambda i: Q.constant_score(flt.ids_in(i.docs, Q.match(i, "text", "the hand", operator="and").raw().select("doc_id"), "doc_id"), "doc_id", flt.match_all()))
text("q23_indices", simple(f"""SELECT doc_id, round(s * {norm_sql(1, 2)}, 6) AS score FROM c1 JOIN documents USING (doc_id) WHERE lang IN ('en', 'de')
    UNION ALL SELECT doc_id, round(s * {norm_sql(1, 2)}, 6) FROM c2 JOIN documents USING (doc_id) WHERE lang NOT IN ('en', 'de')""",
    leaf_sql(1, ["the", "hand"]), leaf_sql(2, ["de", "la"])),
    lambda i: Q.indices(i.docs, ["en", "de"], the(i), Q.match(i, "text", "de la"), "lang"))

text("q23_indices_none", simple(f"SELECT doc_id, round(s * {norm_sql(1)}, 6) AS score FROM c1 JOIN documents USING (doc_id) WHERE lang IN ('en', 'de')",
    leaf_sql(1, ["the", "hand"])), lambda i: Q.indices(i.docs, ["en", "de"], the(i), "none", "lang"))
text("q23_indices_all", simple(f"""SELECT doc_id, round(s * {norm_sql(1)}, 6) AS score FROM c1 JOIN documents USING (doc_id) WHERE lang IN ('en', 'de')
    UNION ALL SELECT doc_id, 1.0::DOUBLE FROM documents WHERE lang NOT IN ('en', 'de')""",
    leaf_sql(1, ["the", "hand"])), lambda i: Q.indices(i.docs, ["en", "de"], the(i), index_column="lang"))

for _mode, _fold in {"avg": "avg(words)", "total": "sum(words)::DOUBLE", "max": "max(words)::DOUBLE", "none": "1.0::DOUBLE"}.items():
    @query(f"q24_nested_{_mode}", f"SELECT doc_id, round({_fold}, 6) AS score FROM {LINES_SQL} WHERE chars > 60 AND last = '.' GROUP BY doc_id")
    def _(t, mode=_mode):
        return scores(Q.nested(t.lines(), "doc_id", "lines", lambda e: e["words"],
                               lambda e: (e["chars"] > 60) & (e["last"] == "."), mode))


ELEMENTS = f"""WITH el AS MATERIALIZED (SELECT row_number() OVER () AS el, doc_id, {standard_sql('lower(s)')} AS t
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents)),
    tok AS (SELECT el, doc_id, len(t) AS field_len, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM el),
    post AS (SELECT el, doc_id, term, count(*) AS tf, any_value(field_len) AS field_len FROM tok WHERE term IN ('the', 'hand') GROUP BY ALL),
    w AS (SELECT q.term, 1 + ln((SELECT count(*)::DOUBLE FROM el) / (count(el) + 1)) AS idf
        FROM (VALUES ('the'), ('hand')) q(term) LEFT JOIN post USING (term) GROUP BY q.term),
    scored AS (SELECT el, doc_id, count(*) AS matched,
            sum(sqrt(tf) / sqrt(field_len) * idf * idf) / sqrt((SELECT sum(idf * idf) FROM w)) * count(*) / 2 AS s
        FROM post JOIN w USING (term) GROUP BY el, doc_id)"""

for _mode, _fold in {"avg": "avg(s)", "max": "max(s)", "total": "sum(s)", "none": "1.0::DOUBLE"}.items():
    @query(f"q24_nested_text_{_mode}", f"{ELEMENTS} SELECT doc_id, round({_fold}, 6) AS score FROM scored GROUP BY doc_id")
    def _(t, mode=_mode):
        """Documents by the scores of those of their lines that match a text."""
        return scores(fold_elements(Q.match(t.line_index(), "line", "the hand"), "doc_id", mode))


@query("q24_nested_text_and", f"{ELEMENTS} SELECT doc_id, round(max(s), 6) AS score FROM scored WHERE matched = 2 GROUP BY doc_id")
def _(t):
    """Both words in one line."""
    return scores(fold_elements(Q.match(t.line_index(), "line", "the hand", operator="and"), "doc_id", "max"))


@query("q24_not_nested_text", f"{ELEMENTS} SELECT doc_id, 1.0::DOUBLE AS score FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM scored WHERE matched = 2)")
def _(t):
    """Documents without a line that holds both words."""
    return scores(Q.not_(fold_elements(Q.match(t.line_index(), "line", "the hand", operator="and"), "doc_id"), t.documents))


@query("q25_has_child", """SELECT c_custkey, 2.0::DOUBLE AS score FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)""")
def _(t):
    return scores(Q.has_child(t.customer, "c_custkey", failed_orders(t), "c_custkey", 2.0))


@query("q26_has_parent", """SELECT o_orderkey, 1.0::DOUBLE AS score FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(t):
    return scores(Q.has_parent(t.orders, "o_orderkey", t.customer.filter("c_mktsegment = 'BUILDING'"), "o_custkey", "c_custkey"))


for _mode in ("max", "sum", "avg"):
    @query(f"q27_top_children_{_mode}", f"SELECT o_custkey AS c_custkey, round({_mode}(o_totalprice), 6) AS score FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey")
    def _(t, mode=_mode):
        children = t.orders.filter("o_orderstatus = 'F'").select("o_custkey", F.col("o_totalprice").alias("score"))
        return scores(Q.top_children(t.customer, "c_custkey", children, "o_custkey", mode))


@query("j04_parent_of_text_children", f"""WITH {POST}, {leaf_sql(1, ['the', 'hand'])} SELECT source, round(max(s * {norm_sql(1)}), 6) AS score
    FROM c1 JOIN documents USING (doc_id) GROUP BY source""")
def _(t):
    """Sources scored by their best matching document."""
    i = t.text_index()
    children = i.docs.select("doc_id", "source").join(the(i).scores(), "doc_id")
    return scores(Q.top_children(i.docs.select("source").distinct(), "source", children, "source", "max"))


@query("j05_element_match", f"SELECT doc_id, count(*) AS matching, max(words) AS best FROM {LINES_SQL} WHERE chars > 60 AND last = '.' GROUP BY doc_id")
def _(t):
    hits = F.filter("lines", lambda e: (e["chars"] > 60) & (e["last"] == "."))
    return t.lines().select("doc_id", hits.alias("h")).filter("size(h) > 0").select(
        "doc_id", F.size("h").cast("long").alias("matching"), F.array_max("h.words").cast("long").alias("best"))


@query("q28_ids", f"SELECT _id, 1.5::DOUBLE AS score FROM {PEOPLE_SQL} WHERE _id IN ('3', '7') AND _type = 'supplier'")
def _(t):
    return scores(Q.ids(t.people(), "_id", [3, 7], "supplier", 1.5))


@query("q29_match_all", "SELECT o_orderkey, 2.0::DOUBLE AS score FROM orders")
def _(t):
    return scores(Q.match_all(t.orders, "o_orderkey", 2.0))


@query("q30_ref_is", "SELECT c_custkey, 1.0::DOUBLE AS score FROM customer WHERE c_custkey % 7 <> 0 AND c_nationkey = 3")
def _(t):
    return scores(Q.ref_is(customer_refs(t), "c_custkey", "ref", {"index": "odd", "type": "nation", "id": "3"}))


@query("q30_not_ref", "SELECT c_custkey, 1.0::DOUBLE AS score FROM customer WHERE c_custkey % 7 = 0 OR c_nationkey <> 3")
def _(t):
    docs = customer_refs(t)
    return scores(Q.not_(Q.ref_is(docs, "c_custkey", "ref", {"index": "odd", "type": "nation", "id": "3"}), docs))


text("q31_boost", bool_sql(["should", "should"], [leaf_sql(1, ["the"], boosts=[4]), leaf_sql(2, ["hand"])], 1, norm_sql(1, 2)),
     lambda i: Q.bool_(should=[Q.boost(Q.term(i, "text", "the"), 4), Q.term(i, "text", "hand")]))
