"""The queries of this folder, and the SQL that checks them where SQL can."""

from __future__ import annotations

from watchloom.llm.align import op11_merge_path_alignment
from watchloom.llm.bpe import op5_byte_bpe
from watchloom.llm.digest import op9_improbable_digest
from watchloom.llm.hosts import op12_host_words
from watchloom.llm.jaccard import op8_parity_join
from watchloom.llm.maxent import op3_maxent_score
from watchloom.llm.media import op2_media_columns
from watchloom.llm.mixing import op1_cube_mix
from watchloom.llm.quality import op6_ordinal_quality
from watchloom.llm.sharding import op7_histogram_shards
from watchloom.llm.toxicity import op10_crf_toxicity
from watchloom.llm.variants import op13_spelling_variants
from watchloom.llm.warc import op4_warc_revisits

QUERIES = {f.__name__: f for f in (op1_cube_mix, op2_media_columns, op4_warc_revisits, op5_byte_bpe, op7_histogram_shards, op8_parity_join, op9_improbable_digest, op6_ordinal_quality, op10_crf_toxicity, op3_maxent_score, op11_merge_path_alignment, op12_host_words, op13_spelling_variants)}

#: WARC-backed result, as the contract words it.
ORACLE = {
    "op4_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS h FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS last FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM f""",
}
