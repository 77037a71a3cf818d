"""The registered queries op1 to op13: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from keyfig.llm import conversations, decontaminate, fingerprint, htmltext, langid, linededup, merkle, neardup, packing, repeats, secrets, topk, warc
from keyfig.llm.common import lookup, stored, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside windows of the benchmark, and the items they are of."""
    docs, name = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"], null_ids=True)
    found = F.col(name)
    longest = F.coalesce(F.array_max(F.transform(found["matches"], lambda m: m["length"])), F.lit(0))
    return docs.select("doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
                       F.size(found["items"]).cast("long").alias("n_items"),
                       F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
                       (found["n_hit"] > 0).alias("contaminated"), longest.alias("longest_match"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written, read back and summed up from its chunks."""
    index = warc.archive(table(spark, sf_dir, "pages"))
    back = warc.summary(warc.read(spark, index))
    return back.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found, name = langid.predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    out = F.col(name)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), out["lang"].alias("lang_pred"),
                        out["score"].alias("score"), out["bits"].alias("code_bits"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern and entropy spans of every text."""
    found, name = secrets.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    out = F.col(name)
    return found.select("doc_id", out["n_assign"].alias("n_assign"), out["n_access"].alias("n_access"), out["n_hex"].alias("n_hex"),
                        F.sha2(out["base"], 256).alias("base_sha256"), out["spans"].alias("spans"), out["n_entropy"].alias("n_entropy"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts and edited texts; documents within the radius, for every 100th id."""
    prints = stored(fingerprint.with_next(table(spark, sf_dir, "documents")), "prints")
    asked = F.pmod("doc_id", F.lit(100)) == 0
    near = stored(fingerprint.within(prints, prints.where(asked)).withColumn("weight", F.lit(1)), "near")
    out = lookup(prints, near, ["bits"], "weight")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                      F.when(asked, F.col("n_within")).alias("n_within"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates and number of linked documents, for every document."""
    return neardup.document_classes(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by differencing with the nearest URLs of its host."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the lines of runs that are at an earlier place."""
    docs, name = linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", f"{name}.n_lines", f"{name}.n_removed", "text")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each text without byte strings of earlier documents."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every 20th id, by integer inner product."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, 20)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and repaired turns of every damaged conversation."""
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    found = conversations.audits(rows, copies="copies")
    prints = conversations.hashed(conversations.repaired(rows, found, copies="copies")).withColumnRenamed("conv", "hashed")
    out = found.join(prints, F.col("conv").eqNullSafe(F.col("hashed")), "left")
    return out.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and witness of every document; what the tampered ones fold to."""
    docs = table(spark, sf_dir, "documents")
    values = lambda n_chars: [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = F.when(changed, merkle.leaf(*values(F.col("n_chars").cast("decimal(20,0)") + 1)))
    found = merkle.manifest(docs, "doc_id", values(F.col("n_chars")), "lang", {"claimed": claimed})
    return merkle.proved(found, "doc_id", "claimed")


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_decontamination, op2_warc, op3_language_id, op4_secrets, op5_fingerprint, op6_ngram_jaccard,
    op7_html_text, op8_line_dedup, op9_repeats, op10_packing, op11_exact_top_k, op12_conversation_repair, op13_merkle_manifest)}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: crc32 of a string in DuckDB: the table by rule, then a byte at a time (reflected polynomial EDB88320).
_CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS v
  FROM (SELECT unnest(range(256))::BIGINT AS n)))"""


def _crc(text: str) -> str:
    return (f"xor(list_reduce(list_transform(range(len(hex(encode({text}))) // 2), lambda k: ('0x' || substr(hex(encode({text})), (2 * k + 1)::INT, 2))::BIGINT), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _more(state: str, cost: str, letter: str) -> str:
    """A state (ten digits of cost, then the audit) with a further edit."""
    return f"(lpad((substr({state}, 1, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || substr({state}, 11) || '{letter}')"


#: DuckDB SQL over the registered views, where SQL can express the whole result.
SQL: dict[str, str] = {
    "op1_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS k FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS g, k
            FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
grams AS (SELECT r, i, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS g
          FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT r, i, k, item_id FROM grams JOIN windows USING (g, k)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
found AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r),
diagonal AS (SELECT r, item_id, i, j, k, i - row_number() OVER (PARTITION BY r, item_id, i - j, k ORDER BY i) AS island
             FROM (SELECT g.r, w.item_id, g.i, w.j, g.k FROM grams g JOIN (
                   SELECT item_id, j, k, list_aggregate(w[j:j + k - 1], 'string_agg', ' ') AS g
                   FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS j FROM sized)) w USING (g, k))),
longest AS (SELECT r, max(n) AS longest_match FROM (SELECT r, count(*) + any_value(k) - 1 AS n FROM diagonal GROUP BY r, item_id, i - j, k, island) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest_match, 0) AS longest_match
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r) LEFT JOIN longest USING (r)""",
    "op2_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS response FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response IS NOT NULL AND response IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response IS DISTINCT FROM page_id THEN response END AS refers_to
FROM r""",
    "op8_line_dedup": """
WITH lines AS (SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line
               FROM documents WHERE text IS NOT NULL),
kept AS (SELECT doc_id, i, line, lead(line) OVER w AS l2, lead(line, 2) OVER w AS l3, lead(i) OVER w AS i2, lead(i, 2) OVER w AS i3
         FROM lines WHERE trim(line) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, i, [i, i2, i3] AS places, line || chr(10) || l2 || chr(10) || l3 AS run FROM kept WHERE i3 IS NOT NULL
         UNION ALL SELECT doc_id, i, [i, i2], line || chr(10) || l2 FROM kept
         WHERE i2 IS NOT NULL AND length(line) - length(replace(line, ' ', '')) + length(l2) - length(replace(l2, ' ', '')) + 2 >= 50
         UNION ALL SELECT doc_id, i, [i], line FROM kept WHERE length(line) - length(replace(line, ' ', '')) + 1 >= 50),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run, len(places) ORDER BY doc_id, i) AS n FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(places) AS i FROM ranked WHERE n > 1)
SELECT d.doc_id, coalesce(n_lines, 1) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(x.text, CASE WHEN d.text IS NULL THEN NULL ELSE '' END) AS text
FROM documents d LEFT JOIN (
  SELECT lines.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed, string_agg(line, chr(10) ORDER BY lines.i) FILTER (gone.i IS NULL) AS text
  FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.i = gone.i GROUP BY lines.doc_id) x ON d.doc_id = x.doc_id""",
    "op9_repeats": """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM docs),
strings AS (SELECT r, doc_id, i, substring(h, 2 * i + 1, 100) AS s FROM starts),
owned AS (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM strings),
gone AS (SELECT r, i, i + 50 AS stop FROM owned WHERE least < doc_id),
marked AS (SELECT *, CASE WHEN i <= max(stop) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM gone),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS span FROM marked),
spans AS (SELECT r, span, min(i) AS a, max(stop) AS b FROM numbered GROUP BY r, span),
cut AS (SELECT r, span, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
parts AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
          FROM cut JOIN docs USING (r) GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substring(h, 2 * last + 1) END)) AS kept_sha256
FROM docs LEFT JOIN parts USING (r)""",
    "op11_exact_top_k": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, coalesce(list_sum(list_transform(list_zip(q.w, v.w), lambda x: coalesce(x[1] * x[2], 0))), 0)::BIGINT AS score
           FROM v AS q JOIN v ON q.r <> v.r WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scores) WHERE rank <= 20""",
    "op12_conversation_repair": f"""
WITH RECURSIVE {_CRC_TABLE},
given AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault FROM conversations, crc_table),
damaged AS (SELECT c, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                   CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM given),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(octet_length(encode(role)) || ':' || role || text)) AS i FROM damaged),
seen AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
                left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) AS pair FROM placed),
faults AS (SELECT *, body = '' AS blank, body <> '' AND again AS duplicate, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS cut FROM seen),
rows AS (SELECT c, i, role, text, initial, blank OR duplicate AS forced, cut::INT AS t, CASE initial WHEN 'u' THEN 0 ELSE 2 END AS cu, CASE initial WHEN 'a' THEN 0 ELSE 2 END AS ca FROM faults),
figures AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                   count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY c),
table_of(c, i, z, s, a, u) AS (
  SELECT DISTINCT c, 0::BIGINT, '0000000000', NULL::VARCHAR, '0000000002I', '0000000004II' FROM given
  UNION ALL
  SELECT c, i, z, s, {(a2 := f"least(a, {_more('z', '2', 'I')}, {_more('s', '2', 'I')}, {_more('u', '2', 'I')})")}, least(u, {_more(f'({a2})', '2', 'I')}) FROM (
    SELECT r.c, r.i, {_more('z', '3', 'D')} AS z,
           least({_more('s', '3', 'D')}, CASE WHEN NOT forced AND initial = 's' THEN {_more('z', 't', 'K')} END) AS s,
           least({_more('a', '3', 'D')}, CASE WHEN NOT forced THEN least({", ".join(_more(x, "cu + t", "' || CASE cu WHEN 0 THEN 'K' ELSE 'R' END || '") for x in "zsu")}) END) AS a,
           least({_more('u', '3', 'D')}, CASE WHEN NOT forced THEN {_more('a', "ca + t", "' || CASE ca WHEN 0 THEN 'K' ELSE 'R' END || '")} END) AS u
    FROM table_of JOIN rows r ON r.c = table_of.c AND r.i = table_of.i + 1)),
best AS (SELECT c, substr(x, 1, 10)::BIGINT AS cost, substr(x, 11) AS audit FROM (SELECT c, least(z, u) AS x FROM table_of JOIN figures USING (c) WHERE i = n)),
letters AS (SELECT c, k, letter, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w AS place
            FROM (SELECT c, generate_subscripts(string_split(audit, ''), 1) AS k, unnest(string_split(audit, '')) AS letter FROM best WHERE audit <> '') WINDOW w AS (PARTITION BY c ORDER BY k)),
kept AS (SELECT l.c, k, place, CASE WHEN letter = 'K' THEN r.role END AS role, CASE WHEN letter = 'I' THEN '' ELSE r.text END AS text,
                coalesce(max((place = 1 AND letter = 'K' AND initial = 's')::INT) OVER (PARTITION BY l.c), 0) AS head
         FROM letters l LEFT JOIN rows r ON r.c = l.c AND r.i = l.i WHERE letter <> 'D'),
joined AS (SELECT c, string_agg(coalesce(role, CASE WHEN (place - 1 - head) % 2 = 0 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY k) AS body FROM kept GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM given) LEFT JOIN figures USING (c) LEFT JOIN best USING (c) LEFT JOIN joined USING (c)""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256({" || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", "text"]))}) AS leaf,
         CASE WHEN {_crc("doc_id::VARCHAR")} % 7 = 0 THEN sha256({" || ".join(map(_field, ["doc_id", "source", "lang", "(n_chars + 1)", "text"]))}) END AS claimed
  FROM documents, crc_table)),
trees(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY p) FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS q FROM trees WHERE len(nodes) = 1),
crown(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY q) FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM crown WHERE len(nodes) > 1),
steps AS (
  SELECT r, level, p // (1 << level) AS place, nodes FROM leaves JOIN trees ON trees.lang IS NOT DISTINCT FROM leaves.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT r, height + level, q // (1 << level), nodes FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang, crown WHERE len(nodes) > 1),
siblings AS (SELECT r, level, place % 2 AS side, nodes[xor(place, 1) + 1] AS d FROM steps),
proofs AS (SELECT r, list(d ORDER BY level) FILTER (d IS NOT NULL) AS ds, list(struct_pack(side := side, d := d) ORDER BY level) AS path FROM siblings GROUP BY r),
folds(r, k, d, path) AS (
  SELECT r, 1, coalesce(claimed, leaf), coalesce(path, []) FROM leaves LEFT JOIN proofs USING (r)
  UNION ALL
  SELECT r, k + 1, sha256(CASE WHEN path[k].side = 1 THEN coalesce(path[k].d, '') || d ELSE d || coalesce(path[k].d, '') END), path FROM folds WHERE k <= len(path))
SELECT doc_id, leaf, subroot, nodes[1] AS root, sha256(coalesce(array_to_string(ds, ''), '')) AS proof_sha256, f.d AS folded_root, f.d = nodes[1] AS verified
FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang JOIN crown ON len(nodes) = 1
LEFT JOIN proofs USING (r) JOIN folds f ON f.r = leaves.r AND f.k = len(f.path) + 1""",
}
