"""Queries of subword tokens and of the classifier trained on them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from reviewflow.operators import sentiment as SE
from reviewflow.operators import subwords as SW
from reviewflow.plans import derive as D
from reviewflow.plans.registry import register
from reviewflow.session import spread

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LABELS = {0: "negative", 1: "neutral", 2: "positive"}

# Every (word, start) that some entry fits, the longest entry there, and the walk from one entry's end to the next.
_ENCODED_SQL = f"""
WITH RECURSIVE v AS (
  SELECT hex(from_base64(entry)) AS h, id FROM read_csv('{VOCABULARY}', delim=' ', header=false, quote='', escape='',
                                                       columns={{'entry': 'VARCHAR', 'id': 'INTEGER'}})),
found AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (
  SELECT doc_id, regexp_extract_all(translate(text, '{SW.UPPER}', '{SW.UPPER.lower()}'), '{SW.WORD}') AS ws FROM documents)),
d AS (SELECT w, hex(encode(' ' || w)) AS h FROM (SELECT DISTINCT w FROM found)),
starts AS (SELECT w, h, unnest(range(length(h) // 2)) AS s FROM d),
spans AS (SELECT w, h, s, unnest(range(1, least((SELECT max(length(h)) // 2 FROM v), length(h) // 2 - s) + 1)) AS n FROM starts),
best AS (SELECT w, s, max(n) AS n, arg_max(id, n) AS id FROM spans JOIN v ON v.h = substr(spans.h, 2 * s + 1, 2 * n) GROUP BY w, s),
walk AS (
  SELECT w, s, n, id FROM best WHERE s = 0
  UNION ALL SELECT b.w, b.s, b.n, b.id FROM walk JOIN best b ON b.w = walk.w AND b.s = walk.s + walk.n),
cut AS (SELECT w, list(id ORDER BY s) AS pieces FROM walk GROUP BY w),
encoded AS (SELECT doc_id, flatten(list(pieces ORDER BY pos)) AS ids FROM found JOIN cut USING (w) GROUP BY doc_id)"""


def _docs(spark, sf_dir):
    return spread(D.table(spark, sf_dir, "documents")).select("doc_id", "text")


@register("q_subwords", f"""{_ENCODED_SQL}
SELECT doc_id, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_pieces, md5(coalesce(array_to_string(ids, ','), '')) AS ids_md5
FROM documents LEFT JOIN encoded USING (doc_id)
""")
def q_subwords(spark, sf_dir):
    """Subword pieces of every whole text."""
    ids = _docs(spark, sf_dir).select("doc_id", SW.encode("text", SW.read_vocabulary(VOCABULARY)).alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_pieces"),
                      F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_md5"))


@register("q_subword_labels", f"""{_ENCODED_SQL},
y AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 WHEN quality = 0 THEN 1 END AS y FROM labels),
hits AS (SELECT y, unnest(ids) AS id FROM y JOIN encoded USING (doc_id) WHERE y IS NOT NULL),
counts AS (SELECT id, c, count(*) FILTER (y = c) AS n FROM hits, (VALUES (0), (1), (2)) k(c) GROUP BY id, c),
total AS (SELECT c, sum(n) + count(*) AS n FROM counts GROUP BY c),
weights AS (SELECT id, c, CAST(round(ln((counts.n + 1) / CAST(total.n AS DOUBLE)) * {SE.MICRO}) AS BIGINT) AS weight FROM counts JOIN total USING (c)),
prior AS (SELECT c, CAST(round(ln(count(y.y) + 1) * {SE.MICRO}) AS BIGINT) AS p
          FROM (VALUES (0), (1), (2)) k(c) LEFT JOIN (SELECT y FROM y JOIN documents USING (doc_id)) y ON y.y = k.c GROUP BY c),
pieces AS (SELECT doc_id, id, count(*) AS times FROM (SELECT doc_id, unnest(ids) AS id FROM encoded) GROUP BY doc_id, id),
weighed AS (SELECT doc_id, c, sum(weight * times) AS x FROM pieces JOIN weights USING (id) GROUP BY doc_id, c),
logits AS (SELECT d.doc_id, c, p + coalesce(x, 0) AS x FROM documents d CROSS JOIN prior LEFT JOIN weighed w USING (doc_id, c)),
winner AS (SELECT doc_id, first(c ORDER BY x DESC, c) AS c FROM logits GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NULL OR regexp_replace(text, '^\\s+|\\s+$', '', 'g') = '' THEN ''
                    ELSE ['negative', 'neutral', 'positive'][c + 1] END AS sentiment
FROM documents JOIN winner USING (doc_id)
""")
def q_subword_labels(spark, sf_dir):
    """A classifier trained on the pieces of the labelled documents; logits in the workers → argmax → label name."""
    docs = _docs(spark, sf_dir)
    labels = D.table(spark, sf_dir, "labels").select("doc_id", F.expr(
        "CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 WHEN quality = 0 THEN 1 END").alias("y"))
    # always by sort and merge: broadcast while the labels are few, the plan and its cost would change with the input
    model = SW.train_subwords(docs.join(labels.hint("merge"), "doc_id"), "text", "y", LABELS, SW.read_vocabulary(VOCABULARY))
    return SE.label_text(docs, "text", model).select("doc_id", "sentiment")
