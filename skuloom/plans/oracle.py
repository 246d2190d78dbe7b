"""SQL text shared by the oracles: the same derived inputs, starting from the given tables."""

# Attributes asked for at each level of a path, as (level, attribute, required).
LEVEL_RULE_ROWS = """(1, 'TIPO', true), (1, 'ref_x', true), (2, 'tamanho', true), (2, 'retorno', false),
    (3, 'preco', true), (3, 'cor', true), (4, 'hierarquia_web', true), (5, 'peso', true), (6, 'largura', true)"""

BRAND = "CASE WHEN p_size <> 17 THEN p_brand END"
PATH = """list_slice(['CAT', p_brand, p_brand || '-' || p_type, 'S' || CAST(p_size AS VARCHAR),
    'L4', 'L5'], 1, p_size % 6 + 1)"""

PATHS = f"""paths AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku, {BRAND} AS brand, p_brand, p_type, p_size, p_name,
         {PATH} AS path
  FROM part)"""

RAW = f"""raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS nome_produto, {BRAND} AS brand,
         a.id, a.name, a.value, a.uom
  FROM part, LATERAL (
    SELECT 'TIPO' AS id, 'Tipo' AS name, CASE WHEN p_size <> 29 THEN p_type END AS value,
           CAST(NULL AS VARCHAR) AS uom
    UNION ALL SELECT 'Tamanho', CASE WHEN p_size = 19 THEN ' ' ELSE 'Tamanho' END,
           CAST(p_size AS VARCHAR),
           CASE WHEN p_size <= 20 THEN 'cm' WHEN p_size <= 30 THEN ' ' END
    UNION ALL SELECT 'PRECO', 'Preço', CASE WHEN p_size = 23 THEN 'n/a'
           ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END, NULL
    UNION ALL SELECT 'brand', 'Marca', {BRAND}, NULL
    UNION ALL SELECT 'INATIVO', 'Inativo', p_name, NULL
    UNION ALL SELECT 'STATUS_EXIB_SITE', 'Exibe',
           CASE WHEN p_type = 'ECONOMY' THEN 'Nao' ELSE 'Sim' END, NULL) a
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_name, {BRAND}, 'RETORNO', 'Retorno', f.l_returnflag, NULL
  FROM part JOIN (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem) f
    ON f.l_partkey = p_partkey)"""

ACTIVE = "('tipo','tamanho','preco','retorno','brand','status_exib_site','asset.host','asset.lang','p_type','p_size')"

EAV = f"""{RAW},
texts AS (
  SELECT *, CASE WHEN trim(coalesce(uom, '')) <> '' THEN value || ' ' || uom ELSE value END AS v
  FROM raw WHERE brand IS NOT NULL AND lower(id) IN {ACTIVE}),
eav AS (
  SELECT DISTINCT 'catalogo' AS origem, sku, nome_produto, id AS atributo, valor FROM (
    SELECT sku, nome_produto, id, brand, coalesce(string_agg(v, ' ; ' ORDER BY v), '') AS valor
    FROM texts GROUP BY sku, nome_produto, id, brand)
  WHERE lower(id) <> 'brand'
  UNION ALL
  SELECT DISTINCT 'catalogo', sku, nome_produto, 'marca', brand FROM raw)"""

ERP_STRING = """erp_string AS (
  SELECT 'part' AS origem, CAST(p_partkey AS VARCHAR) AS sku, '' AS nome_produto, a.atributo, a.valor
  FROM part, LATERAL (
    SELECT 'p_name' AS atributo, p_name AS valor UNION ALL SELECT 'p_brand', p_brand
    UNION ALL SELECT 'p_type', p_type) a)"""

WIDE = f"""{EAV}, {ERP_STRING},
wide AS (
  SELECT sku,
    max(CASE WHEN lower(atributo) = 'tipo' THEN valor END) AS tipo,
    max(CASE WHEN lower(atributo) = 'tamanho' THEN valor END) AS tamanho,
    max(CASE WHEN lower(atributo) = 'preco' THEN valor END) AS preco,
    max(CASE WHEN lower(atributo) = 'retorno' THEN valor END) AS retorno,
    max(CASE WHEN lower(atributo) = 'status_exib_site' THEN valor END) AS status_exib_site,
    max(CASE WHEN lower(atributo) = 'p_type' THEN valor END) AS p_type,
    max(CASE WHEN lower(atributo) = 'p_size' THEN valor END) AS p_size
  FROM (SELECT sku, atributo, valor FROM eav UNION ALL SELECT sku, atributo, valor FROM erp_string
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_size', CAST(p_size AS VARCHAR) FROM part)
  GROUP BY sku)"""

PAGES = """pg AS (
  SELECT page_id, url AS page_url, html, regexp_extract(url, '/([0-9]+)', 1) AS sku,
    split_part(url, '/', 4) AS lang, split_part(url, '/', 3) AS host,
    CASE WHEN url LIKE '%.html' THEN ' ' WHEN url NOT LIKE '%#top' THEN url END AS url,
    CASE WHEN split_part(url, '/', 4) <> 'de' THEN upper(split_part(url, '/', 4)) END AS brand,
    CASE WHEN url LIKE 'https%' THEN 'DOC-manual' WHEN url LIKE '%?%' THEN 'DOC-ficha'
         ELSE 'DOC-cad' END AS type_id,
    CASE WHEN split_part(url, '/', 4) = 'es' THEN ''
         ELSE 'Arquivo-' || split_part(url, '/', 3) END AS nome
  FROM pages)"""

SECTOR = """CASE p_type WHEN 'ECONOMY' THEN 'LS' WHEN 'LARGE' THEN 'HY' WHEN 'MEDIUM' THEN 'MS'
    WHEN 'PROMO' THEN 'LF' WHEN 'SMALL' THEN '01' ELSE 'ZZ' END"""
LINE_VALUE = """coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END,
    CASE WHEN l_linestatus <> 'O' THEN strftime(l_shipdate, '%Y%m%d') END,
    CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR))"""
CHARS = ", ".join(
    f"max(CASE WHEN l_linenumber = {i} THEN {LINE_VALUE} END) AS char_{i}" for i in range(1, 8)
)
CLASSIFIED = f"""classified AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku, {SECTOR} AS setor_atividade, '001' AS tipo_classe,
    '789' || CAST(p_partkey AS VARCHAR) AS codigo_barras, CAST(p_size AS VARCHAR) AS formato,
    'UN' AS unidade_medida_basica, p_brand || '-' || p_type AS prdha, {CHARS}
  FROM part JOIN lineitem ON l_partkey = p_partkey
  GROUP BY p_partkey, p_type, p_size, p_brand)"""

CUSTOMERS = """esq AS (
  SELECT CAST(c_custkey AS VARCHAR) AS sku, c_name AS nome, c_mktsegment AS segmento,
    CAST(c_nationkey AS VARCHAR) AS nacao, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS saldo
  FROM customer),
dir AS (
  SELECT CAST(c_custkey AS VARCHAR) AS sku,
    CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' || upper(c_name) || ' ' ELSE c_name END AS nome,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'OTHER'
         WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segmento,
    CAST(CASE WHEN c_nationkey = 13 THEN 14 ELSE c_nationkey END AS VARCHAR) AS nacao,
    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS saldo
  FROM customer WHERE c_acctbal >= 0)"""

ORDERS = """ord AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sku, o_orderstatus AS status, o_orderpriority AS prioridade,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS valor
  FROM orders),
alvo AS (
  SELECT sku, status, CASE WHEN prioridade = '5-LOW' THEN 'OLD' ELSE prioridade END AS prioridade, valor
  FROM ord WHERE status <> 'P'),
novo AS (SELECT * FROM ord WHERE prioridade <> '1-URGENT')"""

CHANGES = f"""{ORDERS},
mudancas AS (
  SELECT op, sku, status, prioridade, valor,
    CASE WHEN op = 'I' THEN '2024-01-01 00:00:00' ELSE '2020-01-01 00:00:00' END AS created_at,
    CASE WHEN op = 'U' THEN '2024-01-01 00:00:00' WHEN op <> 'I' THEN '2020-01-02 00:00:00' END
      AS updated_at
  FROM (
    SELECT CASE WHEN a.sku IS NULL THEN 'I' WHEN n.sku IS NULL THEN 'D'
             WHEN a.status = n.status AND a.prioridade = n.prioridade AND a.valor = n.valor THEN '='
             ELSE 'U' END AS op,
      coalesce(n.sku, a.sku) AS sku, coalesce(n.status, a.status) AS status,
      coalesce(n.prioridade, a.prioridade) AS prioridade, coalesce(n.valor, a.valor) AS valor
    FROM alvo a FULL JOIN novo n ON a.sku = n.sku))"""

def matrix_all(rule: str) -> str:
    """Required and optional attributes, for the products whose site flag passes ``rule``."""
    return f"""{EAV}, {PATHS},
pedidos AS (
  SELECT DISTINCT p.sku, r.atributo, r.obrigatorio
  FROM paths p JOIN (SELECT * FROM (VALUES {LEVEL_RULE_ROWS}) v(nivel, atributo, obrigatorio)) r
    ON r.nivel <= least(len(p.path), 5)
  WHERE p.p_size <> 13 AND lower(r.atributo) NOT LIKE '%ref%' AND lower(r.atributo) <> 'hierarquia_web'
    AND p.sku IN (SELECT sku FROM eav WHERE lower(atributo) = 'status_exib_site' AND {rule})),
achados AS (SELECT DISTINCT lower(trim(sku)) AS s, lower(trim(atributo)) AS a FROM eav),
matriz AS (
  SELECT p.sku, CASE WHEN p.obrigatorio THEN 'Sim' ELSE 'Não' END AS obrigatorio,
    CASE WHEN f.a IS NOT NULL THEN 'Sim' ELSE 'Não' END AS preenchido
  FROM pedidos p LEFT JOIN achados f ON f.s = lower(trim(p.sku)) AND f.a = lower(trim(p.atributo)))"""


MATRIX = f"""{EAV}, {PATHS},
pedidos AS (
  SELECT DISTINCT p.sku, r.atributo
  FROM paths p JOIN (
    SELECT 1 AS nivel, 'TIPO' AS atributo UNION ALL SELECT 2, 'tamanho' UNION ALL SELECT 3, 'preco'
    UNION ALL SELECT 3, 'cor' UNION ALL SELECT 5, 'peso') r ON r.nivel <= len(p.path)
  WHERE p.p_size <> 13 AND p.sku IN (
    SELECT sku FROM eav WHERE lower(atributo) = 'status_exib_site' AND lower(valor) = 'sim')),
achados AS (
  SELECT lower(trim(sku)) AS s, lower(trim(atributo)) AS a, max(atributo) AS atributo, max(valor) AS valor
  FROM eav GROUP BY 1, 2),
matriz AS (
  SELECT p.sku, p.atributo AS atributo_hierarquia, 'Sim' AS obrigatorio,
    f.atributo AS atributo_golden_record, f.valor,
    CASE WHEN f.atributo IS NOT NULL THEN 'Sim' ELSE 'Não' END AS preenchido
  FROM pedidos p LEFT JOIN achados f ON f.s = lower(trim(p.sku)) AND f.a = lower(trim(p.atributo)))"""
