"""The same queries as plain SQL over the test tables, for the side-by-side check."""

from __future__ import annotations

from twinfold.plans.cards import ALSO_DIRTY

TIDY = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"

NEAT = rf"""
doc AS MATERIALIZED (
  SELECT doc_id, lang, CAST(substr(source, 4) AS INTEGER) AS src,
         string_split(text, chr(10)) AS ls
  FROM documents),
card AS (
  SELECT CASE WHEN src < 7 THEN 'S1' WHEN src < 14 THEN 'S2' ELSE 'S3' END AS origin,
         doc_id, lang, ls, unnest(range(0, (len(ls) + 1) // 2)) AS k
  FROM doc),
raw AS (
  SELECT origin, origin || '-' || doc_id || '-' || k AS entity_id,
         ls[2 * k + 1] AS business_name, ls[2 * k + 2] AS business_address, lang AS country
  FROM card),
neat AS MATERIALIZED (
  SELECT *, {TIDY.format("business_name")} AS clean_name,
         {TIDY.format("business_address")} AS clean_address, country AS clean_country
  FROM raw)"""

SIDES = """
s1 AS (SELECT * EXCLUDE (origin) FROM cards WHERE origin = 'S1'),
c AS (SELECT * EXCLUDE (origin) FROM cards WHERE origin <> 'S1')"""

LINES = f"{NEAT}, cards AS (SELECT * FROM neat), {SIDES}"

# Records with faults, by the number of their document.
DIRTY = f"""{NEAT},
numbered AS (SELECT *, CAST(string_split(entity_id, '-')[2] AS BIGINT) AS d FROM neat),
cards AS MATERIALIZED (
  SELECT * EXCLUDE (d) REPLACE (
    if(d % 19 = 0, '   ', clean_name) AS clean_name,
    if(d % 17 = 0, NULL, clean_address) AS clean_address,
    if(d % 23 = 0, NULL, clean_country) AS clean_country)
  FROM numbered), {SIDES}"""

PARTS = rf"""
raw AS (
  SELECT CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) < 9 THEN 'S1'
              WHEN CAST(substr(p_brand, 7) AS INTEGER) < 17 THEN 'S2' ELSE 'S3' END AS origin,
         p_partkey, p_name AS business_name, 'size ' || p_size AS business_address,
         p_type AS country
  FROM part),
cards AS MATERIALIZED (
  SELECT origin, origin || '-' || p_partkey AS entity_id, business_name, business_address,
         country, {TIDY.format("business_name")} AS clean_name,
         {TIDY.format("business_address")} AS clean_address, country AS clean_country
  FROM raw),
s1 AS (SELECT * EXCLUDE (origin) FROM cards WHERE origin = 'S1'),
c AS (SELECT * EXCLUDE (origin) FROM cards WHERE origin <> 'S1')"""


def exact_pairs(column: str, cap: int | None = None) -> str:
    keep = (
        f"""AND (s.clean_country, s.{column}) IN (
          SELECT (clean_country, {column}) FROM c GROUP BY clean_country, {column}
          HAVING count(*) <= {cap})"""
        if cap
        else ""
    )
    return f"""
      SELECT s.entity_id AS source1_entity_id, c.entity_id AS candidate_entity_id
      FROM s1 s JOIN c ON s.clean_country = c.clean_country AND s.{column} = c.{column}
      WHERE trim(s.{column}) <> '' {keep}"""


def capped(name_cap: int = 200, address_cap: int = 100) -> str:
    return exact_pairs("clean_name", name_cap) + " UNION " + exact_pairs("clean_address", address_cap)


EXACT = exact_pairs("clean_name") + " UNION " + exact_pairs("clean_address")


def record_tokens(table: str, column: str) -> str:
    return f"""
      SELECT * FROM (
        SELECT entity_id, clean_country,
               unnest(list_distinct(string_split({column}, ' '))) AS token
        FROM {table} WHERE trim({column}) <> '')
      WHERE length(token) >= 3"""


def rare(column: str, cap: int = 50) -> str:
    return f"""
      SELECT token, count(*) AS frequency FROM ({record_tokens("c", column)})
      GROUP BY token HAVING count(*) <= {cap}"""


def token_pairs(column: str, cap: int = 50) -> str:
    return f"""
      SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id
      FROM ({record_tokens("s1", column)}) a
      JOIN ({record_tokens("c", column)}) b
        ON a.clean_country = b.clean_country AND a.token = b.token
      WHERE a.token IN (SELECT token FROM ({rare(column, cap)}))"""


def occurrences(column: str, by: str = "") -> str:
    return f"""
      SELECT {by} token, count(*) AS frequency FROM (
        SELECT clean_country, unnest(string_split({column}, ' ')) AS token
        FROM c WHERE trim({column}) <> '')
      WHERE trim(token) <> '' GROUP BY ALL"""


def buckets(column: str) -> str:
    # Labels and bounds of the buckets; the last one is open.
    ranges = [
        ("1", 1, 1), ("2-5", 2, 5), ("6-10", 6, 10), ("11-50", 11, 50), ("51-100", 51, 100),
        ("101-500", 101, 500), ("501-1,000", 501, 1000), ("1,001-5,000", 1001, 5000),
        ("5,001-10,000", 5001, 10000), ("10,001+", 10001, "CAST('inf' AS DOUBLE)"),
    ]
    return " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{label}' AS bucket, count(*) AS tokens
            FROM ({occurrences(column)}) WHERE frequency BETWEEN {low} AND {high}"""
        for i, (label, low, high) in enumerate(ranges, 1)
    )


def ngram_ctes(min_freq: int = 2, max_freq: int = 500, grams: int = 20, top_k: int = 20) -> str:
    """Grams as four runs of non-overlapping pieces, each shifted by one character."""

    def pieces(table: str) -> str:
        return " UNION ALL ".join(
            f"""SELECT entity_id, clean_country, lower(unnest(
                  regexp_extract_all(substr(clean_name, {k}), '(?s).{{4}}'))) AS ngram
                FROM {table} WHERE trim(clean_name) <> '' AND trim(clean_country) <> ''"""
            for k in range(1, 5)
        )

    return f"""
    cg AS MATERIALIZED ({pieces("c")}),
    sg AS MATERIALIZED ({pieces("s1")}),
    freq AS MATERIALIZED (
      SELECT clean_country, ngram, count(*) AS frequency FROM cg GROUP BY ALL),
    useful AS (SELECT * FROM freq WHERE frequency BETWEEN {min_freq} AND {max_freq}),
    ci AS (SELECT DISTINCT entity_id, clean_country, ngram, frequency
           FROM cg JOIN useful USING (clean_country, ngram)),
    si AS (SELECT DISTINCT entity_id, clean_country, ngram, frequency
           FROM sg JOIN useful USING (clean_country, ngram)),
    chosen AS (
      SELECT * FROM si
      QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY frequency, ngram) <= {grams}),
    scores AS MATERIALIZED (
      SELECT s.entity_id AS source1_entity_id, ci.entity_id AS candidate_entity_id,
             count(*) AS shared_ngrams,
             (sum(1000000000000000 // ci.frequency) + 500) // 1000 AS units
      FROM chosen s JOIN ci USING (clean_country, ngram) GROUP BY ALL),
    topk AS MATERIALIZED (
      SELECT source1_entity_id, candidate_entity_id FROM scores
      QUALIFY row_number() OVER (
        PARTITION BY source1_entity_id
        ORDER BY shared_ngrams DESC, units DESC, candidate_entity_id) <= {top_k})"""


TRUTH = """
heads AS (
  SELECT clean_country, clean_name, clean_address, min(entity_id) AS source1_entity_id
  FROM s1 WHERE clean_name <> '' AND clean_address <> '' GROUP BY ALL),
lists AS MATERIALIZED (
  SELECT source1_entity_id,
         string_agg(entity_id, ',' ORDER BY entity_id) AS matched_entity_ids
  FROM c JOIN heads USING (clean_country, clean_name, clean_address)
  GROUP BY source1_entity_id, regexp_replace(entity_id, '-[0-9]+$', '')),
truth AS MATERIALIZED (
  SELECT DISTINCT source1_entity_id, trim(id) AS candidate_entity_id
  FROM (SELECT source1_entity_id, unnest(string_split(matched_entity_ids, ',')) AS id FROM lists)
  WHERE trim(id) <> '')"""


def record_facts(side: int, table: str, id_name: str) -> str:
    """Every record once, with what its comparisons need: per text itself, its folded form
    (empty if there is none) and its length."""
    facts = [
        f"""clean_{t} AS {t}{side}, coalesce(lower(trim(clean_{t})), '') AS {t}{side}_folded,
            CAST(coalesce(length(clean_{t}), 0) AS BIGINT) AS {t}{side}_length"""
        for t in ("name", "address", "country")
    ]
    return f"facts{side} AS (SELECT entity_id AS {id_name}, {', '.join(facts)} FROM {table})"


def same(text: str) -> str:
    return f"if({text}1_folded = {text}2_folded, 1, 0) AS {text}_exact, {text}1, {text}2"


def sizes(text: str) -> str:
    sides = [f"{text}{n}_length, if({text}{n}_folded = '', 1, 0) AS {text}{n}_missing" for n in (1, 2)]
    return f"{', '.join(sides)}, abs({text}1_length - {text}2_length) AS {text}_length_diff"


FEATURES = f"""
{record_facts(1, "s1", "source1_entity_id")},
{record_facts(2, "c", "candidate_entity_id")},
features AS MATERIALIZED (
  SELECT source1_entity_id, candidate_entity_id,
         {same("name")}, {same("address")}, {same("country")}, {sizes("name")}, {sizes("address")}
  FROM pairs JOIN facts1 USING (source1_entity_id) JOIN facts2 USING (candidate_entity_id))"""

NUMERIC = "features.* EXCLUDE (name1, name2, address1, address2, country1, country2)"

SCORED = f"""
pairs AS MATERIALIZED ({token_pairs("clean_name")}),
{FEATURES},
scored AS MATERIALIZED (
  SELECT CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label,
    (CASE WHEN greatest(name1_length, name2_length) = 0 THEN 0
          ELSE 10000 * least(name1_length, name2_length) // greatest(name1_length, name2_length) END
   + CASE WHEN greatest(address1_length, address2_length) = 0 THEN 0
          ELSE 10000 * least(address1_length, address2_length) // greatest(address1_length, address2_length) END
   + 10000 * (name_exact + address_exact)) // 4 / 10000.0 AS score
  FROM features f LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id))"""

F_HALF = """CASE WHEN 0.25 * precision + recall = 0 THEN 0.0
  ELSE 1.25 * precision * recall / (0.25 * precision + recall) END"""

SWEEP = f"""
grid AS (SELECT (10 + 5 * i) / 1000.0 AS threshold FROM (SELECT unnest(range(0, 199)) AS i)),
by_score AS (
  SELECT CAST(score AS DOUBLE) AS score, sum(label) AS pos, count(*) - sum(label) AS neg
  FROM scored GROUP BY ALL),
hits AS (
  SELECT g.threshold, CAST(coalesce(sum(pos), 0) AS BIGINT) AS true_positives,
         CAST(coalesce(sum(neg), 0) AS BIGINT) AS false_positives
  FROM grid g LEFT JOIN by_score b ON b.score >= CAST(g.threshold AS DOUBLE) GROUP BY ALL),
rates AS (
  SELECT *, CASE WHEN true_positives + false_positives = 0 THEN 0.0
              ELSE true_positives / (true_positives + false_positives) END AS precision,
         true_positives / (SELECT sum(label) FROM scored) AS recall
  FROM hits),
sweep AS MATERIALIZED (
  SELECT round(CAST(threshold AS DOUBLE), 6) AS threshold, true_positives, false_positives,
         round(CAST(precision AS DOUBLE), 6) AS precision,
         round(CAST(recall AS DOUBLE), 6) AS recall,
         round(CAST({F_HALF} AS DOUBLE), 6) AS f0_5, {F_HALF} AS f_exact
  FROM rates)"""

RANKED = """
by_score AS (
  SELECT CAST(score AS DOUBLE) AS score, CAST(sum(label) AS DOUBLE) AS pos,
         CAST(count(*) - sum(label) AS DOUBLE) AS neg
  FROM scored GROUP BY ALL),
ranked AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER () AS positives, sum(neg) OVER () AS negatives
  FROM by_score WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def lcs(a: str, b: str) -> str:
    """Subsequence length of two character lists by the textbook table, row by row."""
    return f"""coalesce(list_max(list_reduce(
      list_transform({a}, lambda x: list_transform({b}, lambda y: CASE WHEN x = y THEN 1 ELSE 0 END)),
      lambda old, hit: list_transform(
        list_transform(hit, lambda h, j:
          greatest(old[j], CASE WHEN h = 1 THEN coalesce(old[j - 1], 0) + 1 ELSE 0 END)),
        lambda e, j: list_max(list_transform(hit, lambda h, q:
          CASE WHEN q <= j THEN greatest(old[q],
            CASE WHEN h = 1 THEN coalesce(old[q - 1], 0) + 1 ELSE 0 END) ELSE 0 END))),
      list_transform({b}, lambda y: 0))), 0)"""


def similarity_ctes(field: str) -> str:
    """Scores of all different text pairs of one field."""
    f = field
    chars = lambda t: f"string_split({t}, '')"
    return f"""
    {f}_texts AS MATERIALIZED (
      SELECT DISTINCT coalesce({f}1, '') AS a, coalesce({f}2, '') AS b FROM features),
    {f}_words AS (
      SELECT a, b, list_sort(list_filter(string_split(a, ' '), lambda w: w <> '')) AS wa,
             list_sort(list_filter(string_split(b, ' '), lambda w: w <> '')) AS wb
      FROM {f}_texts),
    {f}_sets AS MATERIALIZED (
      SELECT a, b, wa, wb, array_to_string(wa, ' ') AS sa, array_to_string(wb, ' ') AS sb,
        array_to_string(list_sort(list_distinct(list_filter(wa, lambda w: list_contains(wb, w)))), ' ') AS i,
        array_to_string(list_sort(list_distinct(list_filter(wa, lambda w: NOT list_contains(wb, w)))), ' ') AS da,
        array_to_string(list_sort(list_distinct(list_filter(wb, lambda w: NOT list_contains(wa, w)))), ' ') AS db
      FROM {f}_words),
    {f}_sides AS (
      SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s,
             CASE WHEN length(a) <= length(b) THEN b ELSE a END AS t FROM {f}_texts
      UNION ALL SELECT a, b, b, a FROM {f}_texts WHERE length(a) = length(b)),
    {f}_windows AS (
      SELECT a, b, s, substr(t, p, length(s)) AS w
        FROM {f}_sides, unnest(range(1, length(t) - length(s) + 2)) AS u(p)
      UNION SELECT a, b, s, substr(t, 1, k)
        FROM {f}_sides, unnest(range(1, length(s))) AS u(k)
      UNION SELECT a, b, s, substr(t, length(t) - k + 1)
        FROM {f}_sides, unnest(range(1, length(s))) AS u(k)),
    {f}_distinct AS MATERIALIZED (SELECT DISTINCT s, w FROM {f}_windows),
    {f}_window_lcs AS MATERIALIZED (
      SELECT s, w, {lcs(chars("s"), chars("w"))} AS n FROM {f}_distinct),
    {f}_partial AS (
      SELECT a, b, max(CASE WHEN length(s) = 0 THEN CASE WHEN a = b THEN 100.0 ELSE 0.0 END
               ELSE 200.0 * n / (length(s) + length(w)) END) AS partial
      FROM {f}_windows JOIN {f}_window_lcs USING (s, w) GROUP BY a, b),
    {f}_lcs AS (
      SELECT a, b, sa, sb, i, da, db, wa, wb,
        {lcs(chars("a"), chars("b"))} AS l, {lcs(chars("sa"), chars("sb"))} AS ls,
        {lcs(chars(f"trim(i || ' ' || da)"), chars(f"trim(i || ' ' || db)"))} AS lt,
        {lcs(chars("i"), chars(f"trim(i || ' ' || da)"))} AS la,
        {lcs(chars("i"), chars(f"trim(i || ' ' || db)"))} AS lb
      FROM {f}_sets),
    {f}_scores AS MATERIALIZED (
      SELECT a, b, partial,
        CASE WHEN length(a) + length(b) = 0 THEN 100.0
          ELSE 200.0 * l / (length(a) + length(b)) END AS ratio,
        CASE WHEN length(sa) + length(sb) = 0 THEN 100.0
          ELSE 200.0 * ls / (length(sa) + length(sb)) END AS token_sort,
        CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0 ELSE greatest(
          CASE WHEN length(trim(i || ' ' || da)) + length(trim(i || ' ' || db)) = 0 THEN 0.0 ELSE
            200.0 * lt / (length(trim(i || ' ' || da)) + length(trim(i || ' ' || db))) END,
          CASE WHEN i = '' THEN 0.0 ELSE 200.0 * la / (length(i) + length(trim(i || ' ' || da))) END,
          CASE WHEN i = '' THEN 0.0 ELSE 200.0 * lb / (length(i) + length(trim(i || ' ' || db))) END)
        END AS token_set
      FROM {f}_lcs JOIN {f}_partial USING (a, b))"""


# Subsequences of long texts, a row of the table at a time for all pairs.
NEIGHBOURS = """
WITH RECURSIVE items AS (
  SELECT item_id, text AS a, lead(text) OVER (PARTITION BY substr(text, 1, 1) ORDER BY item_id) AS b
  FROM benchmark),
pairs AS (SELECT item_id, a, b FROM items WHERE b IS NOT NULL),
texts AS (
  SELECT item_id, 'ratio' AS kind, a, b FROM pairs
  UNION ALL
  SELECT item_id, 'token_sort',
    array_to_string(list_sort(list_filter(regexp_split_to_array(a, '\\s+'), lambda w: w <> '')), ' '),
    array_to_string(list_sort(list_filter(regexp_split_to_array(b, '\\s+'), lambda w: w <> '')), ' ')
  FROM pairs),
cells AS (
  SELECT item_id, kind, a, length(a) AS n, length(b) AS m, 0 AS i,
         unnest(range(1, length(b) + 1)) AS j, unnest(string_split(b, '')) AS y, 0 AS v
  FROM texts
  UNION ALL
  SELECT item_id, kind, a, n, m, i + 1, j, y,
         max(greatest(v, CASE WHEN substr(a, i + 1, 1) = y THEN diagonal + 1 ELSE 0 END))
           OVER (PARTITION BY item_id, kind ORDER BY j ROWS UNBOUNDED PRECEDING)
  FROM (SELECT *, coalesce(lag(v) OVER (PARTITION BY item_id, kind ORDER BY j), 0) AS diagonal
        FROM cells WHERE i < n)),
scores AS (
  SELECT item_id, kind, round(200.0 * max(v) / (max(n) + max(m)), 6) AS score
  FROM cells WHERE i = n GROUP BY ALL)
SELECT item_id, max(score) FILTER (kind = 'ratio') AS ratio,
       max(score) FILTER (kind = 'token_sort') AS token_sort_ratio
FROM scores GROUP BY item_id"""


def lines(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([LINES, *ctes])} {select}"


def parts(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([PARTS, *ctes])} {select}"


def pairs_cte(select: str) -> str:
    return f"pairs AS MATERIALIZED ({select})"


def top(table: str, column: str) -> str:
    return lines(
        f"""SELECT {column} AS value, count(*) AS count FROM {table}
            WHERE trim({column}) <> '' GROUP BY ALL ORDER BY count DESC, value LIMIT 20"""
    )


def summary(table: str, column: str) -> str:
    return lines(
        f"""SELECT count(*) AS unique_values, round(avg(n), 6) AS mean,
              round(stddev_samp(n), 6) AS std, min(n) AS min,
              quantile_cont(CAST(n AS DOUBLE), 0.25) AS q25,
              quantile_cont(CAST(n AS DOUBLE), 0.5) AS q50,
              quantile_cont(CAST(n AS DOUBLE), 0.75) AS q75, max(n) AS max
            FROM (SELECT count(*) AS n FROM {table} WHERE trim({column}) <> '' GROUP BY {column})"""
    )


CAPPED = pairs_cte(capped())
PREDICTED = "predicted AS (SELECT * FROM features WHERE name_exact = 1 AND address_exact = 1)"


def id_lists(entities: str, table: str, name: str) -> str:
    return f"""
      SELECT e.entity_id AS source1_entity_id,
             coalesce(string_agg(p.candidate_entity_id, ',' ORDER BY p.candidate_entity_id), '') AS {name}
      FROM (SELECT DISTINCT entity_id FROM {entities}) e
      LEFT JOIN {table} p ON e.entity_id = p.source1_entity_id GROUP BY ALL"""


def checks(entities: str, known: str) -> str:
    """Violations by counting, for lists built from ``predicted`` and ``pairs``."""
    n = f"(SELECT count(DISTINCT entity_id) FROM {entities})"
    rows = "(SELECT count(DISTINCT entity_id) FROM s1)"
    return f"""
      SELECT 'matches_row_difference' AS check_name, abs({rows} - {n}) AS violations
      UNION ALL SELECT 'candidates_row_difference', abs({rows} - {n})
      UNION ALL SELECT 'matches_duplicate_entities', 0
      UNION ALL SELECT 'candidates_duplicate_entities', 0
      UNION ALL SELECT 'matches_outside_candidates', 0
      UNION ALL SELECT 'unknown_matched_ids', (
        SELECT count(DISTINCT candidate_entity_id) FROM predicted
        WHERE candidate_entity_id NOT IN (SELECT entity_id FROM c WHERE {known}))"""


# Faults counted from the lists that hold them: ``twice`` repeats rows, ``marred`` has stray matches.
PLANTED_CHECKS = """
      WITH entity AS (SELECT DISTINCT entity_id FROM s1),
      twice AS (SELECT * FROM entity UNION ALL SELECT * FROM entity WHERE entity_id LIKE '%7'),
      again AS (SELECT count(*) - 1 AS extra FROM twice GROUP BY entity_id),
      marred AS (
        SELECT p.source1_entity_id, p.candidate_entity_id
        FROM predicted p JOIN twice ON source1_entity_id = entity_id
        UNION ALL SELECT entity_id, 'stray-' || entity_id FROM twice WHERE entity_id LIKE '%3'),
      difference AS (SELECT abs((SELECT count(*) FROM twice) - (SELECT count(*) FROM entity)) AS n)
      SELECT 'matches_row_difference' AS check_name, n AS violations FROM difference
      UNION ALL SELECT 'candidates_row_difference', n FROM difference
      UNION ALL SELECT 'matches_duplicate_entities', CAST(sum(extra) AS BIGINT) FROM again
      UNION ALL SELECT 'candidates_duplicate_entities', CAST(sum(extra) AS BIGINT) FROM again
      UNION ALL SELECT 'matches_outside_candidates', count(*) FROM marred m
        WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.source1_entity_id = m.source1_entity_id
                          AND p.candidate_entity_id = m.candidate_entity_id)
      UNION ALL SELECT 'unknown_matched_ids', count(DISTINCT candidate_entity_id) FROM marred
        WHERE candidate_entity_id NOT IN (SELECT entity_id FROM c)"""


def sample_key(ids: str) -> str:
    return f"md5(concat_ws(',', {ids}, '42'))"


BOTH = "source1_entity_id, candidate_entity_id"
LOW = pairs_cte(capped(2, 2))
MISSED = "missed AS (SELECT * FROM truth EXCEPT SELECT * FROM pairs)"
DETAILS = """
  SELECT m.source1_entity_id, a.business_name AS s1_name, a.business_address AS s1_address,
         a.country AS s1_country, a.clean_name AS s1_clean_name, a.clean_address AS s1_clean_address,
         m.candidate_entity_id, b.business_name AS candidate_name,
         b.business_address AS candidate_address, b.country AS candidate_country,
         b.clean_name AS candidate_clean_name, b.clean_address AS candidate_clean_address
  FROM missed m JOIN s1 a ON m.source1_entity_id = a.entity_id
  JOIN c b ON m.candidate_entity_id = b.entity_id"""

NGRAM = ngram_ctes()
COMBINED = " UNION ".join([EXACT, token_pairs("clean_name"), token_pairs("clean_address")])
QUALITY = """
  SELECT true_pairs, captured_pairs, candidate_pairs, all_pairs,
         true_pairs - captured_pairs AS missed_pairs,
         round(CASE WHEN true_pairs = 0 THEN 0.0 ELSE captured_pairs / true_pairs END, 6) AS recall,
         round(CASE WHEN all_pairs = 0 THEN 0.0 ELSE candidate_pairs / all_pairs END, 6) AS candidate_ratio,
         round(1.0 - CASE WHEN all_pairs = 0 THEN 0.0 ELSE candidate_pairs / all_pairs END, 6) AS reduction
  FROM (SELECT (SELECT count(*) FROM truth) AS true_pairs,
               (SELECT count(*) FROM truth JOIN pairs USING (source1_entity_id, candidate_entity_id)) AS captured_pairs,
               (SELECT count(*) FROM pairs) AS candidate_pairs,
               (SELECT count(*) FROM s1) * (SELECT count(*) FROM c) AS all_pairs)"""

ORACLE: dict[str, str] = {
    "cleaned_features": """
      SELECT CAST(p_partkey AS VARCHAR) AS source1_entity_id, p_name AS candidate_entity_id,
             CASE WHEN p_partkey % 3 = 0 OR p_size IS NULL THEN 0.0 ELSE CAST(p_size AS DOUBLE) END AS size,
             CASE WHEN p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0 OR p_partkey % 13 = 0
                    OR p_retailprice IS NULL THEN 0.0 ELSE CAST(p_retailprice AS DOUBLE) END AS price
      FROM part""",
    "entity_view": lines("SELECT * FROM cards"),
    "candidate_table": lines("SELECT * FROM c"),
    "part_view": parts("SELECT * FROM cards"),
    "profile_blanks": lines(
        """SELECT count(*) AS row_count,
             count(*) FILTER (trim(coalesce(clean_name, '')) = '') AS empty_clean_name,
             count(*) FILTER (trim(coalesce(clean_address, '')) = '') AS empty_clean_address
           FROM s1"""
    ),
    "profile_columns": lines(
        " UNION ALL ".join(
            f"""SELECT count(*) AS row_count, CAST(7 AS INTEGER) AS column_count,
                  CAST({i} AS INTEGER) AS position, '{name}' AS column_name,
                  'string' AS data_type, count(*) FILTER ({name} IS NULL) AS missing FROM c"""
            for i, name in enumerate(
                ["entity_id", "business_name", "business_address", "country",
                 "clean_name", "clean_address", "clean_country"], 1)
        )
    ),
    "profile_duplicates": lines(
        """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT clean_name, clean_country FROM c)) AS duplicate_rows,
             count(*) - (SELECT count(*) FROM (SELECT DISTINCT clean_name FROM c)) AS duplicate_ids
           FROM c"""
    ),
    "name_top20": top("c", "clean_name"),
    "address_top20": top("c", "clean_address"),
    "name_freq_summary": summary("c", "clean_name"),
    "address_freq_summary": summary("s1", "clean_address"),
    "profile_columns_all": lines(
        " UNION ALL ".join(
            f"""SELECT origin, count(*) AS row_count, CAST(7 AS INTEGER) AS column_count,
                  CAST({i} AS INTEGER) AS position, '{name}' AS column_name,
                  'string' AS data_type, count(*) FILTER ({name} IS NULL) AS missing
                FROM cards GROUP BY origin"""
            for i, name in enumerate(
                ["entity_id", "business_name", "business_address", "country",
                 "clean_name", "clean_address", "clean_country"], 1)
        )
    ),
    "profile_duplicates_planted": lines(
        """SELECT count(*) FILTER (entity_id LIKE '%7') AS duplicate_rows,
             count(*) FILTER (entity_id LIKE '%7' OR entity_id LIKE '%3') AS duplicate_ids
           FROM cards"""
    ),
    "country_counts": lines("SELECT country, count(*) AS count FROM c GROUP BY ALL"),
    "clean_country_counts": lines(
        "SELECT clean_country, count(*) AS count FROM s1 WHERE clean_country IS NOT NULL GROUP BY ALL"
    ),
    "first_rows": lines("SELECT * FROM s1 ORDER BY entity_id LIMIT 5"),
    "token_top30": lines(
        f"SELECT * FROM ({occurrences('clean_name')}) ORDER BY frequency DESC, token LIMIT 30"
    ),
    "address_token_top30": lines(
        f"SELECT * FROM ({occurrences('clean_address')}) ORDER BY frequency DESC, token LIMIT 30"
    ),
    "token_buckets": lines(buckets("clean_name")),
    "address_token_buckets": lines(buckets("clean_address")),
    "token_country_top15": lines(
        f"""SELECT clean_country, token, frequency, CAST(row_number() OVER w AS INTEGER) AS rank
            FROM ({occurrences('clean_name', 'clean_country,')}) WHERE clean_country IS NOT NULL
            WINDOW w AS (PARTITION BY clean_country ORDER BY frequency DESC, token)
            QUALIFY row_number() OVER w <= 15"""
    ),
    "rare_tokens_name": lines(rare("clean_name")),
    "rare_tokens_address": lines(rare("clean_address")),
    "name_token_pairs_cap10": lines(token_pairs("clean_name", 10)),
    "exact_name_pairs": lines(exact_pairs("clean_name")),
    "exact_address_pairs": lines(exact_pairs("clean_address")),
    "exact_name_pair_total": lines(
        f"SELECT count(*) AS pairs FROM ({exact_pairs('clean_name')})"
    ),
    "block_exact": lines(EXACT),
    "block_capped": lines(capped()),
    "block_capped_low": lines(capped(2, 2)),
    "block_capped_coverage": lines(
        f"""SELECT count(*) AS candidate_pairs,
              count(DISTINCT source1_entity_id) AS covered_entities FROM ({capped()})"""
    ),
    "block_name_tokens": lines(f"{EXACT} UNION {token_pairs('clean_name')}"),
    "block_address_tokens": lines(f"{EXACT} UNION {token_pairs('clean_address')}"),
    "block_combined": lines(COMBINED),
    "ngram_frequency": lines("SELECT * FROM freq", NGRAM),
    "ngram_useful": lines("SELECT * FROM useful", NGRAM),
    "ngram_s1_top": lines("SELECT * FROM chosen", NGRAM),
    "ngram_pair_scores": lines(
        """SELECT source1_entity_id, candidate_entity_id, shared_ngrams,
             round(CAST(units AS BIGINT) / 1e12, 6) AS rarity_score FROM scores""",
        NGRAM,
    ),
    "ngram_topk": lines("SELECT * FROM topk", NGRAM),
    "ngram_topk_low": lines("SELECT * FROM topk", ngram_ctes(max_freq=100, top_k=3)),
    "ngram_new_pairs": lines(f"SELECT * FROM topk EXCEPT ({EXACT})", NGRAM),
    "block_ngram": lines(f"SELECT * FROM topk UNION {COMBINED}", NGRAM),
    "truth_pairs": lines("SELECT * FROM truth", TRUTH),
    "blocking_quality": lines(QUALITY, TRUTH, LOW),
    "missed_pairs": lines("SELECT * FROM missed", TRUTH, LOW, MISSED),
    "missed_details": lines(DETAILS, TRUTH, LOW, MISSED),
    "missed_details_sample": lines(
        f"""SELECT * FROM ({DETAILS}) ORDER BY {sample_key(BOTH)}, {BOTH} LIMIT 7""",
        TRUTH, LOW, MISSED,
    ),
    "pair_features_lines": lines("SELECT * FROM features", CAPPED, FEATURES),
    "pair_features_parts": parts(
        "SELECT * FROM features", NGRAM, pairs_cte("SELECT * FROM topk"), FEATURES
    ),
    "fuzzy_neighbours": NEIGHBOURS,
    "fuzzy_features_parts": parts(
        f"""SELECT {NUMERIC},
              round(n.ratio, 6) AS name_ratio, round(n.partial, 6) AS name_partial_ratio,
              round(n.token_sort, 6) AS name_token_sort_ratio,
              round(n.token_set, 6) AS name_token_set_ratio,
              round(d.ratio, 6) AS address_ratio, round(d.partial, 6) AS address_partial_ratio,
              round(d.token_sort, 6) AS address_token_sort_ratio,
              round(d.token_set, 6) AS address_token_set_ratio
            FROM features
            JOIN name_scores n ON coalesce(name1, '') = n.a AND coalesce(name2, '') = n.b
            JOIN address_scores d ON coalesce(address1, '') = d.a AND coalesce(address2, '') = d.b""",
        NGRAM, pairs_cte("SELECT * FROM topk"), FEATURES,
        similarity_ctes("name"), similarity_ctes("address"),
    ),
    "train_positives": lines(
        f"SELECT {NUMERIC}, 1 AS label FROM features JOIN truth USING ({BOTH})",
        TRUTH, CAPPED, FEATURES,
    ),
    "train_negatives": lines(
        f"SELECT {NUMERIC}, 0 AS label FROM features ANTI JOIN truth USING ({BOTH})",
        TRUTH, CAPPED, FEATURES,
    ),
    "labelled_pairs": lines(
        f"""SELECT p.*, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label
            FROM pairs p LEFT JOIN truth t USING ({BOTH})""",
        TRUTH, CAPPED,
    ),
    "train_sample": lines(
        f"""SELECT {NUMERIC}, 1 AS label FROM features JOIN truth t USING ({BOTH})
            UNION ALL
            (SELECT * FROM (SELECT {NUMERIC}, 0 AS label FROM features ANTI JOIN truth USING ({BOTH}))
             ORDER BY {sample_key(BOTH)}
             LIMIT (SELECT least(1000, 3 * count(*)) FROM features JOIN truth USING ({BOTH})))""",
        TRUTH, CAPPED, FEATURES,
    ),
    "sampled_pairs": lines(f"SELECT * FROM pairs ORDER BY {sample_key(BOTH)} LIMIT 500", CAPPED),
    "split_groups": lines(
        f"""SELECT pairs.*, CASE WHEN g.n <= ceil(0.2 * g.total) THEN 1 ELSE 0 END AS held_out
            FROM pairs JOIN (
              SELECT id, row_number() OVER (ORDER BY {sample_key("id")}) AS n,
                     count(*) OVER () AS total
              FROM (SELECT DISTINCT source1_entity_id AS id FROM pairs)) g
            ON pairs.source1_entity_id = g.id""",
        CAPPED,
    ),
    "threshold_sweep": lines("SELECT * EXCLUDE (f_exact) FROM sweep", TRUTH, SCORED, SWEEP),
    "best_threshold": lines(
        """SELECT * EXCLUDE (f_exact) FROM sweep
           ORDER BY f_exact DESC, threshold LIMIT 1""",
        TRUTH, SCORED, SWEEP,
    ),
    "confusion_counts": lines(
        f"""SELECT true_positives, false_positives, false_negatives, true_negatives,
              round(precision, 6) AS precision, round(recall, 6) AS recall,
              round({F_HALF}, 6) AS f0_5
            FROM (SELECT *,
                CASE WHEN true_positives + false_positives = 0 THEN 0.0
                  ELSE true_positives / (true_positives + false_positives) END AS precision,
                CASE WHEN true_positives + false_negatives = 0 THEN 0.0
                  ELSE true_positives / (true_positives + false_negatives) END AS recall
              FROM (SELECT count(*) FILTER (label = 1 AND score >= 0.9) AS true_positives,
                  count(*) FILTER (label = 0 AND score >= 0.9) AS false_positives,
                  count(*) FILTER (label = 1 AND score < 0.9) AS false_negatives,
                  count(*) FILTER (label = 0 AND score < 0.9) AS true_negatives FROM scored))""",
        TRUTH, SCORED,
    ),
    "roc_auc": lines(
        """SELECT round(sum(pos * (negatives - fp + neg / 2)) / (max(positives) * max(negatives)), 6) AS roc_auc
           FROM ranked""",
        TRUTH, SCORED, RANKED,
    ),
    "average_precision": lines(
        "SELECT round(sum(pos * tp / (tp + fp)) / max(positives), 6) AS average_precision FROM ranked",
        TRUTH, SCORED, RANKED,
    ),
    "predicted_pairs": lines(f"SELECT {BOTH} FROM predicted", CAPPED, FEATURES, PREDICTED),
    "output_matches": lines(
        id_lists("s1", "predicted", "matched_entity_ids"), CAPPED, FEATURES, PREDICTED
    ),
    "output_candidates": lines(id_lists("s1", "pairs", "candidate_entity_ids"), CAPPED),
    "output_read_back": lines(
        id_lists("s1", "predicted", "matched_entity_ids"), CAPPED, FEATURES, PREDICTED
    ),
    "output_checks": lines(checks("s1", "true"), CAPPED, FEATURES, PREDICTED),
    "output_checks_planted": lines(f"SELECT * FROM ({PLANTED_CHECKS})", CAPPED, FEATURES, PREDICTED),
    "output_checks_wrong_table": lines(
        checks("(SELECT * FROM c WHERE entity_id LIKE 'S2-%')", "entity_id LIKE 'S3-%'"),
        CAPPED, FEATURES, PREDICTED,
    ),
    "tsv_read_back": lines(
        """SELECT entity_id, nullif(clean_name, '') AS clean_name,
             nullif(clean_address, '') AS clean_address, clean_country FROM c"""
    ),
    "parquet_read_back": lines("SELECT entity_id, clean_name, clean_address, clean_country, country FROM c"),
    "sorted_file_order": lines("SELECT count(*) AS rows, CAST(0 AS BIGINT) AS misplaced FROM c"),
    "positive_pairs_read_back": lines(f"SELECT {BOTH} FROM predicted", CAPPED, FEATURES, PREDICTED),
    "report_read_back": lines("SELECT * EXCLUDE (f_exact) FROM sweep", TRUTH, SCORED, SWEEP),
    "record_read_back": lines(
        "SELECT * EXCLUDE (f_exact) FROM sweep ORDER BY f_exact DESC, threshold LIMIT 1",
        TRUTH, SCORED, SWEEP,
    ),
    # What holds for any matcher: the model itself is not SQL.
    "matcher_checks": lines(
        f"""SELECT (SELECT count(*) FROM pairs) AS pairs, CAST(0 AS BIGINT) AS outside_unit_range,
              CAST(0 AS BIGINT) AS wrong_predictions, CAST(0 AS BIGINT) AS wrongly_listed,
              (SELECT count(*) FROM pairs JOIN truth USING ({BOTH})) AS known_matches,
              (SELECT count(*) FROM pairs ANTI JOIN truth USING ({BOTH})) AS others,
              CAST(21 AS BIGINT) AS features, CAST(1000000 AS BIGINT) AS importance_millionths,
              CAST(199 AS BIGINT) AS sweep_rows, CAST(10 AS BIGINT) AS first_rows_scored""",
        TRUTH, CAPPED,
    ),
}

ORACLE |= {f"{name}_dirty": ORACLE[name].replace(LINES, DIRTY) for name in ALSO_DIRTY}
