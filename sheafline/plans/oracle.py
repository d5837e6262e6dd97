"""What the queries must give, in SQL for DuckDB over the same tables.

Written from the definitions, with other means than the Spark expressions:
windows by ranges, dense numbers by ``row_number``, vectors by grouping.
"""

from __future__ import annotations

from sheafline.plans import views as v

_BLANKS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


FILES = f"""
files AS (
  SELECT doc_id, text, category, source_file_name,
    '{v.ROOT}' || category || sub || '/' || source_file_name AS source_file,
    '보험>' || category || replace(sub, '/', '>') AS doc_path,
    strlen(text) AS file_size_bytes,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS file_modified_at,
    'doc_' || doc_id AS document_id
  FROM (
    SELECT *, {_list(v.CATEGORIES)}[(doc_id % 11 + 1)::INT] AS category,
      CASE WHEN doc_id % 11 = 7
        THEN '/' || {_list(v.UNDERWRITING)}[((doc_id // 11) % 3 + 1)::INT] ELSE '' END AS sub,
      'doc_' || doc_id || '.md' AS source_file_name
    FROM documents
  )
)"""

AGENT = """CASE
    WHEN doc_path IN ('보험>언더라이팅>단체언더라이팅', '보험>언더라이팅>언더_공통', '보험>변경>단체변경')
      OR doc_path LIKE '보험>언더라이팅>단체언더라이팅>%' OR doc_path LIKE '보험>언더라이팅>언더_공통>%'
      OR doc_path LIKE '보험>변경>단체변경>%' THEN '단체신계약'
    WHEN doc_path = '보험>언더라이팅>개인언더라이팅' OR doc_path LIKE '보험>언더라이팅>개인언더라이팅>%' THEN '개인신계약'
    WHEN doc_path = '보험>상품' OR doc_path LIKE '보험>상품>%' THEN '상품'
    WHEN doc_path = '보험>사고보험금' OR doc_path LIKE '보험>사고보험금>%' THEN '사고보험금'
    ELSE 'Default' END"""

METADATA = f"CAST(json_object('doc_path', doc_path, 'agent_id', {AGENT}) AS VARCHAR)"

SLUG = """CASE category
    WHEN 'CRM' THEN 'crm' WHEN '발급' THEN 'issuance' WHEN '방카슈랑스' THEN 'bancassurance'
    WHEN '변경' THEN 'change' WHEN '보전' THEN 'conservation' WHEN '사고보험금' THEN 'accident_benefit'
    WHEN '상품' THEN 'product' WHEN '언더라이팅' THEN 'underwriting'
    WHEN '업무별_연락처' THEN 'tasks_contact_address' WHEN '제지급금' THEN 'payment_amount'
    WHEN '콜센터지침' THEN 'call_center_guideline' ELSE lower(category) END"""

SILVER = f"""{FILES},
silver AS (
  SELECT * FROM (
    SELECT *, trim(regexp_replace(text, '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ') AS full_text FROM files
  ) WHERE length(full_text) > 0
)"""

# Windows of 1000 characters every 800; blank ones go before numbering.
CHUNKS = f"""{SILVER},
windows AS (
  SELECT *, substr(full_text, (start + 1)::BIGINT, 1000) AS piece
  FROM (SELECT *, unnest(range(0, length(full_text), 800)) AS start FROM silver)
),
chunks AS (
  SELECT *, trim(piece, ' ') AS chunk_content,
    CASE WHEN length(full_text) <= 1000 THEN 'single' ELSE 'overlap' END AS chunk_type
  FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS INTEGER) AS chunk_idx
    FROM windows WHERE regexp_matches(piece, '[^{_BLANKS}]')
  ) WHERE length(trim(piece, ' ')) > 0
),
keyed AS (
  SELECT *, md5(document_id || '_0_' || chunk_idx) AS chunk_id, {METADATA} AS metadata, {AGENT} AS agent_id,
    'text' AS element_type, CAST(NULL AS INTEGER) AS element_page, CAST(0 AS INTEGER) AS element_idx
  FROM chunks
)"""

_CHUNK = """document_id, source_file_name, source_file, element_type, element_page, element_idx,
  chunk_idx, chunk_content, chunk_type"""

ARRIVALS = f"""
arrivals AS (
  SELECT '{v.ROOT}CRM/user_' || user_id || '.md' AS source_file, 'user_' || user_id || '.md' AS source_file_name,
    event_id AS file_size_bytes, ts AS file_modified_at, ts AS ingested_at, event_id
  FROM events
)"""

_LEDGER = "source_file, source_file_name, file_size_bytes, file_modified_at, ingested_at"

VERSIONS = f"""{ARRIVALS},
versions AS (
  SELECT {_LEDGER}, version_number, total_versions, version_number = total_versions AS is_latest_version
  FROM (
    SELECT *,
      CAST(row_number() OVER (PARTITION BY source_file
        ORDER BY file_modified_at, ingested_at, file_size_bytes, event_id) AS INTEGER) AS version_number,
      CAST(count(*) OVER (PARTITION BY source_file) AS INTEGER) AS total_versions
    FROM arrivals
  )
)"""

STRATEGY = f"""
strategy AS (
  SELECT doc_id, text, 'doc_' || doc_id AS document_id,
    's3://lake/landing/documents/' || {_list(v.STRATEGY_FOLDERS)}[(doc_id % 4 + 1)::INT]
      || '/doc_' || doc_id || '.pdf' AS source_file,
    ['none', 'fixed', 'overlap', 'none'][(doc_id % 4 + 1)::INT] AS chunk_mode,
    CAST([NULL, 500, 500, NULL][(doc_id % 4 + 1)::INT] AS INTEGER) AS chunk_size,
    CAST([NULL, 0, 100, NULL][(doc_id % 4 + 1)::INT] AS INTEGER) AS chunk_overlap
  FROM documents
)"""

INDEX_COLUMNS = "chunk_id, document_id, chunk_content, source_file_name, chunk_idx, chunk_type, metadata"

SNAPSHOTS = f"""{CHUNKS},
old AS (SELECT {INDEX_COLUMNS} FROM keyed WHERE doc_id IN (SELECT doc_id FROM labels)),
new AS (
  SELECT chunk_id, document_id,
    CASE WHEN quality = 0 THEN '[v2] ' || chunk_content ELSE chunk_content END AS chunk_content,
    source_file_name, chunk_idx, chunk_type, metadata
  FROM keyed LEFT JOIN labels USING (doc_id) WHERE toxic IS DISTINCT FROM 1
)"""

PARSED = """
elements AS (
  SELECT 'doc_' || doc_id AS document_id, doc_id, i,
    CASE WHEN i % 4 = 3 THEN 'figure' WHEN i % 4 = 2 THEN 'table' ELSE 'text' END AS kind,
    CASE WHEN i % 8 = 7 THEN NULL
      WHEN i % 4 = 2 THEN '<table><tr><td>' || line || '</td></tr></table>' ELSE line END AS content,
    CASE WHEN i % 8 = 7 THEN line END AS description
  FROM (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
  )
)"""


def _table_text(column, document):
    text = f"regexp_replace({column}, '</tr>', chr(10), 'g')"
    text = f"regexp_replace({text}, '</t[dh]>', ' | ', 'g')"
    text = f"regexp_replace({text}, '<[^>]+>', '', 'g')"
    text = f"regexp_replace({text}, ' \\| *(\\n|$)', '\\1', 'g')"
    if document:
        text = f"regexp_replace({text}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"trim({text}, ' ')"


# Character counts modulo 64 of chunks and of query texts.
COUNTS = f"""{CHUNKS},
chunk_counts AS (
  SELECT chunk_id, unicode(c) % {v.DIMENSION} AS slot, count(*) AS n
  FROM (SELECT chunk_id, unnest(regexp_extract_all(chunk_content, '(?s).')) AS c FROM keyed) GROUP BY ALL
)"""

SCORES = f"""{COUNTS},
query_counts AS (
  SELECT item_id AS query_id, unicode(c) % {v.DIMENSION} AS slot, count(*) AS n
  FROM (SELECT item_id, unnest(regexp_extract_all(text, '(?s).')) AS c FROM benchmark) GROUP BY ALL
),
scores AS (
  SELECT query_id, chunk_id, agent_id, {_list(v.AGENTS)}[(query_id % 5 + 1)::INT] AS asked,
    round(dot / (sqrt(q.norm) * sqrt(c.norm)), 6) AS score
  FROM (
    SELECT query_id, chunk_id, CAST(sum(q.n * c.n) AS DOUBLE) AS dot
    FROM query_counts q JOIN chunk_counts c USING (slot) GROUP BY ALL
  )
  JOIN (SELECT query_id, CAST(sum(n * n) AS DOUBLE) AS norm FROM query_counts GROUP BY ALL) q USING (query_id)
  JOIN (SELECT chunk_id, CAST(sum(n * n) AS DOUBLE) AS norm FROM chunk_counts GROUP BY ALL) c USING (chunk_id)
  JOIN keyed USING (chunk_id)
)"""


def _best(source, k, id_column="chunk_id", where="true"):
    return f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, {id_column}, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {id_column}) AS rank
      FROM {source} WHERE {where}) WHERE rank <= {k}"""


STATUS = f"""{CHUNKS},
status AS (
  SELECT category, {SLUG} AS table_slug, coalesce(row_count, 0) AS row_count,
    CASE WHEN row_count > 0 THEN 'unified' ELSE 'skipped' END AS status
  FROM (SELECT DISTINCT category FROM files UNION ALL SELECT 'Archive')
  LEFT JOIN (SELECT category, count(*) AS row_count FROM keyed GROUP BY 1) USING (category)
)"""

ORACLE = {
    "file_ledger": f"WITH {FILES} SELECT source_file, source_file_name, file_size_bytes, file_modified_at, file_modified_at AS ingested_at FROM files",
    "ledger_increment": f"WITH {ARRIVALS} SELECT {_LEDGER} FROM arrivals WHERE ingested_at >= TIMESTAMP '2024-01-20 00:00:00'",
    "document_versions": f"WITH {VERSIONS} SELECT * FROM versions",
    "latest_documents": f"WITH {VERSIONS} SELECT * FROM versions WHERE is_latest_version",
    "category_list": f"WITH {FILES} SELECT DISTINCT category FROM files ORDER BY category",
    "category_slug": f"WITH {FILES} SELECT source_file, category, {SLUG} AS table_slug FROM files",
    "category_fanout": f"""WITH {FILES} SELECT category, file_count,
        {SLUG} || unnest(['_bronze_documents', '_silver_documents', '_silver_document_chunks', '_gold_document_embeddings']) AS table_name
        FROM (SELECT category, count(*) AS file_count FROM files GROUP BY 1)""",
    "category_filter": f"WITH {FILES} SELECT source_file, source_file_name, file_size_bytes, file_modified_at, file_modified_at AS ingested_at FROM files WHERE category = 'CRM'",
    "document_id": f"WITH {FILES} SELECT source_file, document_id FROM files",
    "doc_path": f"WITH {FILES} SELECT source_file, doc_path FROM files",
    "agent_route": f"WITH {FILES} SELECT source_file, doc_path, {AGENT} AS agent_id FROM files",
    "chunk_metadata": f"WITH {FILES} SELECT source_file, {METADATA} AS metadata FROM files",
    "bronze_documents": f"""WITH {FILES} SELECT document_id, source_file_name, source_file, file_size_bytes,
        file_modified_at, file_modified_at AS ingested_at, 'bronze' AS bronze_layer, md5(text) AS content_md5 FROM files""",
    "silver_documents": f"""WITH {SILVER} SELECT document_id, source_file_name, source_file, full_text, file_size_bytes,
        file_modified_at, file_modified_at AS ingested_at, 'silver' AS silver_layer FROM silver""",
    "text_preview": f"WITH {SILVER} SELECT document_id, left(full_text, 500) AS text_preview FROM silver",
    "html_table_text": f"SELECT page_id, {_table_text('html', True)} AS page_text FROM pages",
    "html_element_text": f"SELECT page_id, {_table_text('html', False)} AS page_text FROM pages",
    "parsed_ok": "SELECT 'doc_' || doc_id AS document_id FROM documents WHERE length(text) >= 100",
    "element_text": f"""WITH {PARSED} SELECT document_id,
        coalesce(string_agg(content, chr(10) || chr(10) ORDER BY i)
          FILTER (WHERE kind <> 'figure' AND length(trim(content, ' ')) > 0), '') AS full_text
        FROM elements GROUP BY document_id""",
    "figure_text": f"""WITH {PARSED} SELECT document_id,
        coalesce(string_agg(coalesce(description, content), chr(10) || chr(10) ORDER BY i)
          FILTER (WHERE kind = 'figure' AND (length(trim(description, ' ')) > 0 OR length(trim(content, ' ')) > 0)), '')
          AS figure_descriptions
        FROM elements GROUP BY document_id""",
    "page_count": f"WITH {PARSED} SELECT document_id, CAST(max(i) // 10 + 1 AS INTEGER) AS page_count FROM elements GROUP BY document_id",
    "elements_explode": f"""WITH {PARSED} SELECT document_id, kind AS element_type, CAST(i // 10 AS INTEGER) AS element_page,
        CAST(i AS INTEGER) AS element_idx, {_table_text('coalesce(content, description)', False)} AS element_text
        FROM elements WHERE length(trim(coalesce(content, description), ' ')) > 0""",
    "parsed_silver": f"""WITH {PARSED}, said AS (
          SELECT document_id, doc_id, CAST(max(i) // 10 + 1 AS INTEGER) AS page_count,
            coalesce(string_agg(content, chr(10) || chr(10) ORDER BY i)
              FILTER (WHERE kind <> 'figure' AND length(trim(content, ' ')) > 0), '') AS said,
            coalesce(string_agg(coalesce(description, content), chr(10) || chr(10) ORDER BY i)
              FILTER (WHERE kind = 'figure' AND (length(trim(description, ' ')) > 0 OR length(trim(content, ' ')) > 0)), '')
              AS figure_descriptions
          FROM elements GROUP BY ALL)
        SELECT document_id, {_table_text('said', True)} AS full_text, figure_descriptions, page_count
        FROM said JOIN documents USING (doc_id) WHERE length(text) >= 100""",
    "element_chunks": f"""WITH {PARSED}, each AS (
          SELECT document_id, kind AS element_type, CAST(i // 10 AS INTEGER) AS element_page, CAST(i AS INTEGER) AS element_idx,
            {_table_text('coalesce(content, description)', False)} AS element_text
          FROM elements JOIN documents USING (doc_id)
          WHERE length(trim(coalesce(content, description), ' ')) > 0 AND length(text) >= 100),
        pieces AS (
          SELECT *, substr(element_text, (start + 1)::BIGINT, 1000) AS piece
          FROM (SELECT *, unnest(range(0, length(element_text), 800)) AS start FROM each)),
        numbered AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY document_id, element_idx ORDER BY start) - 1 AS INTEGER) AS chunk_idx
          FROM pieces WHERE regexp_matches(piece, '[^{_BLANKS}]'))
        SELECT document_id, document_id || '.pdf' AS source_file_name, document_id || '.pdf' AS source_file, element_type,
          element_page, element_idx, chunk_idx, trim(piece, ' ') AS chunk_content,
          CASE WHEN length(element_text) <= 1000 THEN 'single' ELSE 'overlap' END AS chunk_type,
          md5(document_id || '_' || element_idx || '_' || chunk_idx) AS chunk_id
        FROM numbered WHERE length(trim(piece, ' ')) > 0""",
    "chunk_windows": f"""WITH {SILVER}, windows AS (
          SELECT document_id, start, substr(full_text, (start + 1)::BIGINT, 1000) AS piece
          FROM (SELECT *, unnest(range(0, length(full_text), 800)) AS start FROM silver))
        SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY start) - 1 AS INTEGER) AS chunk_index,
          CAST(start AS INTEGER) AS start_offset, CAST(start + length(piece) AS INTEGER) AS end_offset, md5(piece) AS chunk_md5
        FROM windows WHERE regexp_matches(piece, '[^{_BLANKS}]')""",
    "chunks_overlap": f"WITH {CHUNKS} SELECT {_CHUNK} FROM keyed",
    "chunks_positional": f"""WITH {SILVER} SELECT document_id, source_file_name, source_file, 'text' AS element_type,
        CAST(NULL AS INTEGER) AS element_page, CAST(0 AS INTEGER) AS element_idx, CAST(start // 800 AS INTEGER) AS chunk_idx,
        trim(substr(full_text, (start + 1)::BIGINT, 1000), ' ') AS chunk_content,
        CASE WHEN length(full_text) <= 1000 THEN 'single' ELSE 'overlap' END AS chunk_type
        FROM (SELECT *, unnest(range(0, length(full_text), 800)) AS start FROM silver)
        WHERE length(trim(substr(full_text, (start + 1)::BIGINT, 1000), ' ')) > 0""",
    "chunk_strategy": f"WITH {STRATEGY} SELECT source_file, chunk_mode, chunk_size, chunk_overlap FROM strategy",
    "chunks_by_strategy": f"""WITH {STRATEGY},
        pieces AS (
          SELECT *, substr(text, (start + 1)::BIGINT, coalesce(chunk_size, length(text))) AS piece FROM (
            SELECT *, unnest(range(0, length(text), coalesce(chunk_size - chunk_overlap, length(text)))) AS start
            FROM strategy WHERE length(trim(text, ' ')) > 0
          )
        ),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS n
          FROM pieces WHERE regexp_matches(piece, '[^{_BLANKS}]')
        )
        SELECT document_id, source_file, chunk_mode, CAST(n AS INTEGER) AS chunk_idx, trim(piece, ' ') AS chunk_content,
          CASE WHEN chunk_mode = 'none' OR length(text) <= chunk_size THEN 'single' ELSE 'overlap' END AS chunk_type
        FROM numbered WHERE length(trim(piece, ' ')) > 0""",
    "chunk_id": f"WITH {CHUNKS} SELECT document_id, element_idx, chunk_idx, chunk_id FROM keyed",
    "metadata_filter": f"""WITH {CHUNKS} SELECT doc_path, count(*) AS chunk_count FROM keyed
        WHERE json_extract_string(metadata, '$.agent_id') = '개인신계약' GROUP BY 1""",
    "embed_chunks": f"""WITH {COUNTS} SELECT chunk_id, CAST({v.DIMENSION} AS INTEGER) AS dimension, vector FROM (
          SELECT chunk_id, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY slot) AS vector
          FROM (SELECT chunk_id, unnest(range({v.DIMENSION})) AS slot FROM keyed)
          LEFT JOIN chunk_counts USING (chunk_id, slot) GROUP BY 1)""",
    "embed_outcome": f"""WITH {CHUNKS} SELECT chunk_type, count(*) AS total_count,
        count(*) FILTER (WHERE length(chunk_content) >= 200) AS embedded_count,
        count(*) FILTER (WHERE length(chunk_content) < 200) AS failed_count FROM keyed GROUP BY 1""",
    "agent_route_table": """WITH filed AS (
          SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, s_nationkey, s_nationkey || '>' || l_suppkey || '>' || l_partkey AS doc_path
          FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        ),
        back AS (SELECT doc_path, min(l_linestatus) AS mode FROM filed WHERE l_returnflag = 'R' GROUP BY 1)
        SELECT l_orderkey, l_linenumber, doc_path,
          coalesce(mode, CASE WHEN (1099511627776 + n_nationkey) % 5 <> 0 THEN n_name END, 'Default') AS agent_id
        FROM filed LEFT JOIN back USING (doc_path) LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "embedding_health": f"""SELECT count(*) AS total_count, count(*) FILTER (WHERE embedding IS NULL) AS missing_count,
        count(*) FILTER (WHERE len(embedding) <> {v.DIMENSION}) AS wrong_dimension_count,
        count(*) FILTER (WHERE len(embedding) = {v.DIMENSION}) AS healthy_count FROM embeddings""",
    "index_projection": f"WITH {CHUNKS} SELECT {INDEX_COLUMNS} FROM keyed",
    "rows_per_category": f"WITH {CHUNKS} SELECT category, count(*) AS row_count FROM keyed GROUP BY 1",
    "unify_sources": f"WITH {STATUS} SELECT * FROM status",
    "unified_gold": f"WITH {CHUNKS} SELECT {_CHUNK}, chunk_id, metadata FROM keyed",
    "run_tally": f"""WITH {STATUS} SELECT count(*) FILTER (WHERE status = 'unified') AS success_count,
        count(*) FILTER (WHERE status <> 'unified') AS fail_count, count(*) AS total_count FROM status""",
    "index_sync_changes": f"""WITH {SNAPSHOTS} SELECT chunk_id,
          CASE WHEN o.document_id IS NULL THEN 'insert' WHEN n.document_id IS NULL THEN 'delete' ELSE 'update' END AS op
        FROM new n FULL JOIN old o USING (chunk_id)
        WHERE o.document_id IS NULL OR n.document_id IS NULL
          OR (n.document_id, n.chunk_content, n.source_file_name, n.chunk_idx, n.chunk_type, n.metadata)
            IS DISTINCT FROM (o.document_id, o.chunk_content, o.source_file_name, o.chunk_idx, o.chunk_type, o.metadata)""",
    "index_sync_apply": f"WITH {SNAPSHOTS} SELECT * FROM new",
    "vector_topk": f"""WITH parts AS (
          SELECT vec_id, label, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) AS slot FROM embeddings
        ),
        centres AS (SELECT CAST(label AS BIGINT) AS query_id, slot, avg(value) AS value FROM parts GROUP BY ALL),
        vectors AS (SELECT vec_id, list(value ORDER BY slot) AS vector FROM parts GROUP BY 1),
        wanted AS (SELECT query_id, list(value ORDER BY slot) AS centre FROM centres GROUP BY 1),
        scored AS (
          SELECT query_id, vec_id, round(list_cosine_similarity(vector, centre), 6) AS score FROM vectors, wanted
        ) {_best('scored', 10, 'vec_id')}""",
    "vector_topk_dirty": f"""WITH parts AS (
          SELECT vec_id, label, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) AS slot FROM embeddings
        ),
        centres AS (SELECT CAST(label AS BIGINT) AS query_id, slot, avg(value) AS value FROM parts GROUP BY ALL),
        vectors AS (SELECT vec_id, list(value ORDER BY slot) AS vector FROM parts WHERE label > 4 GROUP BY 1),
        wanted AS (SELECT query_id, list(value ORDER BY slot) AS centre FROM centres GROUP BY 1),
        scored AS (
          SELECT query_id, vec_id, round(list_cosine_similarity(vector, centre), 6) AS score FROM vectors, wanted
        ) {_best('scored', 10, 'vec_id')}""",
    "text_topk": f"WITH {SCORES} {_best('scores', 5)}",
    "vector_topk_filtered": f"WITH {SCORES} {_best('scores', 5, where='agent_id = asked')}",
    "vector_topk_clustered": f"WITH {SCORES} {_best('scores', 5, where="agent_id = '개인신계약'")}",
    "vector_topk_overfetch": f"""WITH {SCORES},
        wide AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS place FROM scores)
        {_best('wide', 5, where="place <= 20 AND agent_id = asked")}""",
    "report_counters": f"""WITH {CHUNKS} SELECT count(DISTINCT document_id) AS document_count,
        count(DISTINCT source_file_name) AS source_file_count, count(chunk_id) AS chunk_count, count(*) AS row_count FROM keyed""",
    "chunks_per_document": f"WITH {CHUNKS} SELECT document_id, count(chunk_id) AS chunk_count FROM keyed GROUP BY 1",
    "chunk_detail": f"WITH {CHUNKS} SELECT document_id, source_file_name, chunk_idx, chunk_type FROM keyed",
    "pk_violations": """SELECT 'conv_' || conv_id AS document_id, count(*) AS row_count
        FROM conversations GROUP BY 1 HAVING count(*) > 1""",
    "not_null_violations": f"""WITH {CHUNKS}, labelled AS (SELECT keyed.*, quality FROM keyed LEFT JOIN labels USING (doc_id))
        SELECT 'chunk_id' AS column_name, count(*) - count(chunk_id) AS null_count FROM labelled
        UNION ALL SELECT 'document_id', count(*) - count(document_id) FROM labelled
        UNION ALL SELECT 'element_page', count(*) - count(element_page) FROM labelled
        UNION ALL SELECT 'quality', count(*) - count(quality) FROM labelled""",
    "fk_orphans": f"""WITH {CHUNKS} SELECT document_id, count(*) AS row_count FROM keyed
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""",
}

# However often a text occurs and whenever it is embedded, its vector is the same.
ORACLE["embed_once"] = ORACLE["embed_chunks"]
