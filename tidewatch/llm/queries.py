"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_pack")
def op4_pack(spark, sf_dir):
    """Every document packed into sequences of at most 2048 tokens."""
    from tidewatch.llm import packing

    return packing.pack(table(ready(spark), sf_dir, "documents"), vocabulary(packing.VOCABULARY))


BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, body, strlen(body) AS payload_bytes, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_page FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', 1 + CAST(
    (CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN first_page IS NULL OR page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page OR page_id IS NULL THEN first_page END AS refers_to,
  TRUE AS digest_matches
FROM h
"""


@query("op1_warc", WARC_SQL)
def op1_warc(spark, sf_dir):
    """Every page written to an archive and read back from it."""
    from tidewatch.llm import warc

    return warc.summary(warc.read(warc.write(table(ready(spark), sf_dir, "pages"))))


@query("op10_rules")
def op10_rules(spark, sf_dir):
    """Base counts and the learned verdict of every document."""
    from tidewatch.llm import rules

    docs = table(ready(spark), sf_dir, "documents")
    return rules.judge(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


@query("op3_dart_minhash")
def op3_dart_minhash(spark, sf_dir):
    """Near-duplicate group of every document."""
    from tidewatch.llm import minhash

    return minhash.near_duplicates(table(ready(spark), sf_dir, "documents")).drop("digest")


@query("op6_cdc_dedup")
def op6_cdc_dedup(spark, sf_dir):
    """Every document without the passages that an earlier one has."""
    from tidewatch.llm import cdc

    docs = table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return cdc.remove_passages(docs)


PROBE = "</s>[INST] ok [/INST]"


def _chat_sql() -> str:
    from tidewatch.llm import chat

    def escaped(column: str) -> str:
        out = rf"replace({column}, '\', '\\')"
        for c in chat.CONTROLS:
            out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
        return out

    room = chat.BUDGET - chat.HISTORY
    slack = max(1, min(chat.HISTORY, room // 2))
    return rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
s AS (SELECT *, '{chat.OPEN}' || replace({escaped("role")}, chr(10), '\' || chr(10)) || chr(10) || {escaped("text")} || '{chat.CLOSE}' || chr(10) AS seg FROM r),
n AS (SELECT *, CAST(ceil(strlen(seg) / 4.0) AS BIGINT) AS n, row_number() OVER o AS pos, sum(CAST(ceil(strlen(seg) / 4.0) AS BIGINT)) OVER (o ROWS UNBOUNDED PRECEDING) AS til
  FROM s WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
w AS (SELECT conv_id, min(pos) FILTER (role = '{chat.ROLE_SYSTEM}') AS sys_pos, arg_min(length(seg), pos) FILTER (role = '{chat.ROLE_SYSTEM}') AS sys_len,
    {room} - coalesce(CASE WHEN arg_min(n, pos) FILTER (role = '{chat.ROLE_SYSTEM}') < {room} THEN arg_min(n, pos) FILTER (role = '{chat.ROLE_SYSTEM}') END, 0) AS room FROM n GROUP BY conv_id),
o AS (SELECT n.*, w.* EXCLUDE (conv_id), CASE WHEN n > room - {slack} + 1 THEN 1 ELSE 0 END AS is_over FROM n JOIN w ON n.conv_id IS NOT DISTINCT FROM w.conv_id),
q AS (SELECT *, til - n AS begins, sum(n * (1 - is_over)) OVER u - n * (1 - is_over) AS before, 2 * sum(is_over) OVER u - is_over AS shift,
    greatest(max(room) OVER c - coalesce(max(n) FILTER (is_over = 0) OVER c, 0) + 1, 1) AS stride
  FROM o WINDOW u AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING), c AS (PARTITION BY conv_id)),
p AS (SELECT *, before // stride + shift AS span FROM q),
spans AS (SELECT conv_id, span, min(begins) AS first_at, max(max(span) FILTER (pos = sys_pos)) OVER (PARTITION BY conv_id) AS sys_span, any_value(sys_len) AS sys_len FROM p GROUP BY conv_id, span),
chars AS (SELECT conv_id, length(seg) AS c FROM p UNION ALL SELECT conv_id, sys_len FROM spans WHERE span > sys_span
  UNION ALL SELECT p.conv_id, length(p.seg) FROM p JOIN spans ON p.conv_id IS NOT DISTINCT FROM spans.conv_id
    AND first_at - begins BETWEEN 1 AND {chat.HISTORY} WHERE pos IS DISTINCT FROM sys_pos),
total AS (SELECT conv_id, CAST(sum(c) AS BIGINT) AS formatted_chars FROM chars GROUP BY conv_id),
said AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = '{chat.ROLE_TARGET}'), '') AS loss FROM n GROUP BY conv_id)
SELECT said.conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM said JOIN total ON said.conv_id IS NOT DISTINCT FROM total.conv_id
"""


@query("op9_chat", _chat_sql())
def op9_chat(spark, sf_dir):
    """Every conversation formatted and read back, with one that imitates control strings."""
    from tidewatch.llm import chat

    rows = table(ready(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.windows(rows.unionByName(probe)))


VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT r.u, p.w FROM reach r JOIN pairs p ON r.w = p.u)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT u AS vec_id, min(w) AS component_id FROM reach GROUP BY u)
LEFT JOIN (SELECT u AS vec_id, count(*) AS n FROM pairs GROUP BY u) USING (vec_id)
"""


@query("op8_embed_dedup", VECTOR_SQL)
def op8_embed_dedup(spark, sf_dir):
    """Links and components of all vectors inside their labels."""
    from tidewatch.llm import embed

    return embed.duplicate_vectors(table(ready(spark), sf_dir, "embeddings"))


@query("op2_quality_mil")
def op2_quality_mil(spark, sf_dir):
    """Quality score of every document."""
    from tidewatch.llm import quality

    docs = table(ready(spark), sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query("op5_toxicity_ssk")
def op5_toxicity_ssk(spark, sf_dir):
    """Toxicity score of every document."""
    from tidewatch.llm import toxicity

    docs = table(ready(spark), sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op7_spm_wfst")
def op7_spm_wfst(spark, sf_dir):
    """Piece numbers of every document, and whether decoding gives the text back."""
    from tidewatch.llm import spm

    model = vocabulary(spm.MODEL)
    docs = table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    both = spm.decode(spm.encode(docs, model), model)
    plain = F.replace("text", F.lit(spm.SPACE), F.lit(" "))
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.col("decoded").eqNullSafe(plain).alias("restored"))


@query("op12_bpe_words")
def op12_bpe_words(spark, sf_dir):
    """Token counts of every document, digests of its ids and of the text decoded from them."""
    from tidewatch.llm import bpe

    path = vocabulary(bpe.VOCABULARY)
    docs = table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, path), path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    """Every vector whitened along the leading components."""
    from tidewatch.llm import whiten

    return whiten.whiten(table(ready(spark), sf_dir, "embeddings"))


def _repair_sql() -> str:
    blank = r"[\x20\x09-\x0D]"
    ink = r"[^\x20\x09-\x0D]"
    spoken = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

    def edit(letter: str, cost: str, rest: str) -> str:
        return f"printf('%09d', CAST(substr({rest}, 1, 9) AS BIGINT) + {cost}) || '{letter}' || substr({rest}, 10)"

    def read(state: str, to: str, keeps: str) -> str:
        more = "CASE fault WHEN 'truncated' THEN 3 ELSE 0 END"
        kept = "".join(f" WHEN initial = '{i}' THEN {edit('K', more, s)}" for i, s in (k.split(">") for k in keeps.split()))
        sound = f"least({edit('R', f'3 + {more}', to)}, CASE{kept} END)"
        return f"least({edit('D', '4', state)}, CASE WHEN fault IN ('truncated', '') THEN {sound} END)"

    def closed(state: str, one: str, two: str) -> str:
        return f"least({state}, {edit('I', '3', one)}, {edit('I', '3', '(' + edit('I', '3', two) + ')')})"

    return rf"""
WITH RECURSIVE base AS (SELECT conv_id, coalesce(conv_id, -9223372036854775807) AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split({spoken}, ''),
      lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CAST(3988292384 AS BIGINT) * (a & 1)) END), CAST(4294967295 AS BIGINT)) % 20 AS h FROM conversations),
damaged AS (SELECT c, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM base WHERE h <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
flagged AS (SELECT c, i, turn, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS earlier,
    CASE WHEN NOT regexp_matches(text, '{ink}') THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '({ink}){blank}*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered),
counted AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM flagged GROUP BY c),
paths AS (SELECT c, n + 1 AS i, '000000000' AS q0, '000000006II' AS qs, '000000003I' AS qu, '000000000' AS qa FROM counted
  UNION ALL SELECT c, i, {closed("r0", "ru", "ra")}, {closed("rs", "ru", "ra")}, {closed("ru", "ra", "ru")}, {closed("ra", "ru", "ra")} FROM
    (SELECT p.c, f.i, {read("q0", "qu", "s>qs u>qu")} AS r0, {read("qs", "qu", "u>qu")} AS rs, {read("qu", "qa", "a>qa")} AS ru, {read("qa", "qu", "u>qu")} AS ra
     FROM paths p JOIN flagged f ON f.c = p.c AND f.i = p.i - 1)),
audits AS (SELECT c, CAST(substr(q0, 1, 9) AS BIGINT) AS cost, substr(q0, 10) AS audit FROM paths WHERE i = 1),
letters AS (SELECT c, audit, k, substr(audit, k, 1) AS letter, 1 + length(replace(substr(audit, 1, k - 1), 'I', '')) AS i,
    length(replace(substr(audit, 1, k), 'D', '')) AS place FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS k FROM audits)),
steps AS (SELECT l.c, l.k, l.place, l.letter, f.role, f.text,
    bool_or(l.place = 1 AND l.letter = 'K' AND f.initial = 's') OVER (PARTITION BY l.c) AS headed
  FROM letters l LEFT JOIN flagged f ON l.c = f.c AND l.i = f.i AND l.letter <> 'I' WHERE l.letter <> 'D'),
texts AS (SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place + CAST(headed AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired FROM steps GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM base) LEFT JOIN counted USING (c) LEFT JOIN audits USING (c) LEFT JOIN texts USING (c)
"""


@query("op11_repair", _repair_sql())
def op11_repair(spark, sf_dir):
    """Every conversation damaged by a fixed rule and repaired by the cheapest edits."""
    from tidewatch.llm import repair

    return repair.digests(repair.repair(repair.damage(table(ready(spark), sf_dir, "conversations"))))
