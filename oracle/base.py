"""The clean title table written as flat DuckDB SQL over the star schema.

This is deliberately a different formulation from the Spark side: no
nested documents, no arrays, just joins, ``string_agg`` and CASE rules
applied directly to the flat columns.  Every oracle query starts from the
CTE chain below.

``docs`` is MATERIALIZED: without it DuckDB 2.0.0 pushes null-rejecting
filters through the left join and fails with an internal dictionary-cache
error on the sf0.001 tables.
"""

# Spark's round(x, 2) (half-up on the shortest decimal form) in DuckDB.
def r2(expr: str) -> str:
    return f"CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,2))::DOUBLE"


def davg2(expr: str) -> str:
    """Mean over exact decimals, rounded like Spark."""
    return r2(f"AVG(CAST({expr} AS DECIMAL(38,10)))")


def dsum2(expr: str) -> str:
    """Sum over exact decimals, rounded half away from zero to 2 places."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(38,10))) AS DECIMAL(38,2))::DOUBLE"


# Fixed placeholder values (the same as the engine's).
PLACEHOLDERS = "('No Data', '', 'N/A', 'no data', 'NA')"

LINES_CTE = """
li AS (
  SELECT l.l_orderkey AS k, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_returnflag, s.s_name, sn.n_name AS s_nation, r.r_name, p.p_type, p.p_brand
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN region r ON sn.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
agg AS (
  SELECT k,
    SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS rev_cents,
    SUM(l_linenumber) AS sum_line,
    COUNT(*) AS n_lines,
    COUNT(DISTINCT p_type) AS n_types,
    SUM(l_quantity) AS qty,
    string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS genre_s,
    string_agg(DISTINCT r_name, '|' ORDER BY r_name) AS lang_s,
    string_agg(DISTINCT s_nation, '|' ORDER BY s_nation) AS country_s,
    string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS company_s,
    string_agg(s_name, '|' ORDER BY s_name) AS cast_s,
    string_agg(CASE WHEN l_returnflag = 'R' THEN s_name END, '|' ORDER BY s_name) AS director_s
  FROM li GROUP BY k
),
docs AS MATERIALIZED (
  SELECT o.o_orderkey AS k, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
         o.o_orderpriority, c.c_name, c.c_acctbal, c.c_mktsegment, cn.n_name AS cn,
         a.rev_cents, a.sum_line, a.n_lines, a.n_types, a.qty, a.genre_s, a.lang_s, a.country_s,
         a.company_s, a.cast_s, a.director_s,
         (o.o_orderkey % 31 = 0) AS sparse
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  LEFT JOIN agg a ON a.k = o.o_orderkey
),
raw AS (
  SELECT k,
    CASE WHEN k % 97 <> 0 THEN 'Title ' || CAST(k AS VARCHAR) END AS title,
    CASE o_orderstatus WHEN 'F' THEN 'Released' WHEN 'O' THEN 'Post Production'
                       WHEN 'P' THEN 'Planned' END AS status,
    CASE WHEN NOT sparse THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'N/A'
         WHEN 'HOUSEHOLD' THEN '' ELSE c_name END END AS overview_raw,
    CASE WHEN NOT sparse THEN CASE o_orderpriority WHEN '5-LOW' THEN 'No Data'
         WHEN '3-MEDIUM' THEN 'no data' WHEN '1-URGENT' THEN 'NA'
         ELSE o_orderpriority END END AS tagline_raw,
    CASE WHEN NOT sparse THEN CASE WHEN k % 23 = 0 THEN ''
         WHEN k % 29 = 0 THEN '1999-13-01'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS release_raw,
    CASE WHEN k % 2 = 0 THEN 'en' ELSE 'fr' END AS original_language,
    CASE WHEN NOT sparse THEN '/' || CAST(k AS VARCHAR) || '.jpg' END AS poster_path,
    CASE WHEN NOT sparse THEN CASE WHEN k % 11 = 0 THEN 0
         ELSE CAST(round(o_totalprice * 100) AS BIGINT) END END AS budget_raw,
    CASE WHEN NOT sparse THEN CASE WHEN k % 13 = 0 THEN 0 ELSE rev_cents END END AS revenue_raw,
    CASE WHEN NOT sparse THEN CASE WHEN k % 19 = 0 THEN 0 ELSE sum_line * 10 END END AS runtime_raw,
    CASE WHEN NOT sparse THEN CASE WHEN k % 17 = 0 THEN 0
         ELSE CAST(qty AS BIGINT) END END AS votes_raw,
    CASE WHEN NOT sparse THEN CAST(sum_line AS DOUBLE) / n_lines END AS rating_raw,
    CASE WHEN NOT sparse THEN c_acctbal END AS popularity,
    CASE WHEN NOT sparse AND c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')
         THEN cn || ' Collection' END AS belongs_to_collection,
    CASE WHEN NOT sparse THEN genre_s END AS genres,
    CASE WHEN NOT sparse THEN lang_s END AS spoken_languages,
    CASE WHEN NOT sparse THEN country_s END AS production_countries,
    CASE WHEN NOT sparse THEN company_s END AS production_companies,
    CASE WHEN NOT sparse THEN cast_s END AS cast_names,
    CASE WHEN NOT sparse THEN director_s END AS director_names,
    CASE WHEN NOT sparse THEN COALESCE(n_lines, 0) ELSE 0 END AS n_credits,
    CASE WHEN NOT sparse THEN cn END AS origin_country,
    CASE WHEN NOT sparse THEN CASE WHEN n_lines IS NOT NULL THEN n_types
         WHEN k % 2 = 0 THEN 0 END END AS raw_genre_count,
    CASE WHEN NOT sparse THEN n_lines END AS raw_cast_count
  FROM docs
),
copies AS (
  SELECT o_orderkey AS k, 0 AS copy FROM orders
  UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 10 = 0
  UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderkey % 101 = 0
),
rows AS (
  SELECT CASE WHEN c.copy = 2 THEN NULL ELSE r.k END AS rid, r.*
  FROM raw r JOIN copies c ON c.k = r.k
),
typed AS (
  SELECT CAST(rid AS BIGINT) AS id, title, status,
    CASE WHEN tagline_raw NOT IN {ph} THEN tagline_raw END AS tagline,
    TRY_CAST(release_raw AS DATE) AS release_date,
    NULLIF(genres, '') AS genres,
    NULLIF(belongs_to_collection, '') AS belongs_to_collection,
    original_language,
    CAST(NULLIF(budget_raw, 0) AS DOUBLE) / 1000000 AS budget_musd,
    CAST(NULLIF(revenue_raw, 0) AS DOUBLE) / 1000000 AS revenue_musd,
    NULLIF(production_companies, '') AS production_companies,
    NULLIF(production_countries, '') AS production_countries,
    CAST(votes_raw AS BIGINT) AS vote_count,
    CASE WHEN votes_raw = 0 THEN NULL ELSE rating_raw END AS vote_average,
    popularity,
    CAST(NULLIF(runtime_raw, 0) AS BIGINT) AS runtime,
    CASE WHEN overview_raw NOT IN {ph} THEN overview_raw END AS overview,
    NULLIF(spoken_languages, '') AS spoken_languages,
    poster_path,
    NULLIF(cast_names, '') AS "cast",
    CAST(n_credits AS INTEGER) AS cast_size,
    NULLIF(director_names, '') AS director,
    CAST(n_credits AS INTEGER) AS crew_size,
    origin_country
  FROM rows
),
deduped AS (
  SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY id ORDER BY title) = 1
),
released AS (
  SELECT * EXCLUDE (status) FROM deduped
  WHERE id IS NOT NULL AND title IS NOT NULL AND status = 'Released'
),
clean_wide AS (
  SELECT *
  FROM released
  WHERE (id IS NOT NULL)::INT + (title IS NOT NULL)::INT + (tagline IS NOT NULL)::INT
      + (release_date IS NOT NULL)::INT + (genres IS NOT NULL)::INT
      + (belongs_to_collection IS NOT NULL)::INT + (original_language IS NOT NULL)::INT
      + (budget_musd IS NOT NULL)::INT + (revenue_musd IS NOT NULL)::INT
      + (production_companies IS NOT NULL)::INT + (production_countries IS NOT NULL)::INT
      + (vote_count IS NOT NULL)::INT + (vote_average IS NOT NULL)::INT
      + (popularity IS NOT NULL)::INT + (runtime IS NOT NULL)::INT
      + (overview IS NOT NULL)::INT + (spoken_languages IS NOT NULL)::INT
      + (poster_path IS NOT NULL)::INT + ("cast" IS NOT NULL)::INT
      + (cast_size IS NOT NULL)::INT + (director IS NOT NULL)::INT
      + (crew_size IS NOT NULL)::INT + (origin_country IS NOT NULL)::INT >= 10
),
clean AS (
  SELECT id, title, tagline, release_date, genres, belongs_to_collection, original_language,
         budget_musd, revenue_musd, production_companies, production_countries, vote_count,
         vote_average, popularity, runtime, overview, spoken_languages, poster_path, "cast",
         cast_size, director, crew_size
  FROM clean_wide
),
metrics AS (
  SELECT *, revenue_musd - budget_musd AS profit,
         CASE WHEN revenue_musd IS NOT NULL AND budget_musd > 0
              THEN revenue_musd / budget_musd END AS roi
  FROM clean
)""".replace("{ph}", PLACEHOLDERS)


def with_clean(body: str) -> str:
    """Prefix ``body`` (which may add ``, name AS (...)`` CTEs first) with
    the clean-table CTE chain."""
    body = body.strip()
    if body.startswith(","):
        return "WITH " + LINES_CTE.strip() + body
    return "WITH " + LINES_CTE.strip() + "\n" + body
