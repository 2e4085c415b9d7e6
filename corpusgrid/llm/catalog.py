"""Registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgrid.llm.chat import format_conversations, read_back
from corpusgrid.llm.fingerprints import with_neighbours
from corpusgrid.llm.html_extract import extract
from corpusgrid.llm.langid import held_out, identify
from corpusgrid.llm.line_dedup import dedup_lines
from corpusgrid.llm.minhash import near_duplicates
from corpusgrid.llm.neighbors import search
from corpusgrid.llm.packing import pack
from corpusgrid.llm.phrases import collocations
from corpusgrid.llm.pii import KINDS, find
from corpusgrid.llm.registry import ORACLE, QUERIES, query
from corpusgrid.llm.runs import detect_runs
from corpusgrid.llm.sentencepiece import decode, encode
from corpusgrid.llm.token_counts import count_tokens

__all__ = ["ORACLE", "QUERIES"]


@query("op1_language_id", "documents")
def language_id(docs: DataFrame) -> DataFrame:
    return identify(docs.select("doc_id", "text", "lang")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op2_best_fit_packing", "documents")
def best_fit_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)


@query("op4_line_dedup", "documents", r"""
WITH lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    keyed AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
    shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
    marked AS (SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS lost FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def line_dedup(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ESCAPES = r"(length({0}) - length(replace({0}, '\', '')) + len(regexp_extract_all({0}, '<\||</?s>|<</?SYS>>|\[/?INST\]')))"


@query("op10_chat_formatting", "conversations", rf"""
WITH rows_ AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    parts AS (SELECT *, length(role) + {ESCAPES.format('role')} + length(text) + {ESCAPES.format('text')} + 24 AS chars FROM rows_)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM parts GROUP BY conv_id""")
def chat_formatting(turns: DataFrame) -> DataFrame:
    same = "</s>[INST] ok [/INST]"
    extra = turns.sparkSession.createDataFrame(
        [(-1, 0, "user", same), (-1, 1, "assistant", same)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turns.select("conv_id", "turn", "role", "text").unionByName(extra)))


@query("op5_sentencepiece", "documents")
def sentencepiece(docs: DataFrame) -> DataFrame:
    """Ids of every whole text, decoded again; ``decoded_sha256`` equals the digest of the text."""
    encoded = encode(docs).withColumn("n_ids", F.size("ids").cast("long"))
    return decode(encoded).select("doc_id", "n_ids", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


@query("op7_pii", "documents")
def pii(docs: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"))
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


@query("op6_minhash_near_dedup", "documents")
def minhash_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "class_id", "kept")


@query("op8_fingerprints", "documents")
def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints and likenesses; ``near_doc_id`` is the least document of the class found alike through the bands."""
    return with_neighbours(docs)


@query("op9_nearest_neighbors", "embeddings")
def nearest_neighbors(embeddings: DataFrame) -> DataFrame:
    return search(embeddings)


@query("op3_html_extraction", "pages")
def html_extraction(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query("op11_periodic_runs", "documents")
def periodic_runs(docs: DataFrame) -> DataFrame:
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return detect_runs(docs, replace=True).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", "exponent_milli",
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_phrase_collocations", "documents", r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    parted AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM parted GROUP BY lang),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM parted),
    grams AS (SELECT lang, i, w, unnest([1, 2, 3, 4, 5]) AS k FROM starts),
    counted AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM grams WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
    listed AS (SELECT *, string_split(phrase, ' ') AS w FROM counted),
    longer AS (SELECT lang, array_to_string(w[2:], ' ') AS phrase, f FROM listed WHERE k > 1
        UNION SELECT lang, array_to_string(w[:k - 1], ' '), f FROM listed WHERE k > 1),
    kept AS (SELECT * FROM listed ANTI JOIN longer USING (lang, phrase, f) WHERE k > 1),
    cuts AS (SELECT lang, phrase, w, k, f AS a, unnest(range(1, k)) AS c FROM kept),
    scored AS (SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts JOIN counted x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[:c], ' ')
            JOIN counted y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[c + 1:], ' ') JOIN totals ON totals.lang = cuts.lang),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest QUALIFY rank <= 2000""")
def phrase_collocations(docs: DataFrame) -> DataFrame:
    return collocations(docs).drop("cut")


@query("op13_token_counts", "documents")
def token_counts(docs: DataFrame) -> DataFrame:
    """Counts through a new cache, so that every distinct text of the table is a miss once."""
    return count_tokens(docs)
