"""The SQL that each query must equal, for DuckDB views of the same tables."""

from __future__ import annotations

from bindings.queries import BASELINES, ITEM_RULES, K_VALUES, MEASURES, PART_RULES, SEARCHED, SEASON_ENDS, SEED

# the width of the vectors of the test tables; the queries read it off the table
DIMENSIONS = [f"e{i}" for i in range(64)]


def r6(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {name}"


def digest(purpose: str, *keys: str, seed: int = SEED) -> str:
    parts = " || '-' || ".join([f"'{seed}-{purpose}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"md5({parts})"


def draw_int(purpose: str, *keys: str) -> str:
    return f"CAST('0x' || substr({digest(purpose, *keys)}, 1, 8) AS BIGINT)"


def draw_unit(purpose: str, *keys: str) -> str:
    return f"({draw_int(purpose, *keys)} / 4294967296.0::DOUBLE)"


def each(columns, template: str, glue: str = " UNION ALL ") -> str:
    return glue.join(template.format(c=c, i=i) for i, c in enumerate(columns))


def split_ctes(source: str, label: str, row_id: str, fraction: float, columns: str = "*") -> str:
    """CTEs ending in ``parted``: the rows of ``source`` with their split."""
    f = f"{fraction}::DOUBLE"
    return f"""
    src AS ({source}),
    sizes AS (SELECT {label} AS c, count(*) AS n FROM src GROUP BY 1),
    quota AS (SELECT c, n, CAST(floor(round({f} * n, 9)) AS BIGINT) AS given FROM sizes),
    parts AS (SELECT c, given, round({f} * n - given, 9) AS part FROM quota),
    rest AS (SELECT CAST(ceil(round({f} * sum(n), 9)) AS BIGINT) - CAST(sum(given) AS BIGINT) AS k FROM quota),
    wanted AS (
      SELECT c, given + CASE WHEN row_number() OVER (ORDER BY part DESC, c) <= (SELECT k FROM rest)
                             THEN 1 ELSE 0 END AS n_test FROM parts),
    ordered AS (
      SELECT src.*, row_number() OVER (PARTITION BY {label} ORDER BY {digest('split', row_id)}, {row_id}) AS place
      FROM src),
    parted AS (
      SELECT ordered.* EXCLUDE (place), CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split
      FROM ordered JOIN wanted ON {label} = c)"""


ORDERS_SPLIT = split_ctes("SELECT o_orderkey, o_orderpriority FROM orders", "o_orderpriority", "o_orderkey", 0.2)
PART_SPLIT = split_ctes(
    "SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part", "p_type", "p_partkey", 0.5
)
VECTOR_SPLIT = split_ctes(
    "SELECT vec_id, CAST(label AS BIGINT) AS label, embedding::DOUBLE[] AS e FROM embeddings", "label", "vec_id", 0.2
)
SQUARED = "list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

CODES = """codes AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS code, o_orderpriority AS name FROM orders)"""


def describe() -> str:
    one = f"""SELECT '{{c}}' AS "column", count({{c}}) AS "count", {r6('avg({c})', 'mean')},
      {r6('stddev_samp({c})', 'std')}, {r6('min({c})', '"min"')}, {r6('quantile_cont({c}, 0.25)', 'q25')},
      {r6('quantile_cont({c}, 0.5)', 'q50')}, {r6('quantile_cont({c}, 0.75)', 'q75')}, {r6('max({c})', '"max"')}
      FROM lineitem"""
    return each(MEASURES, one)


def audit() -> str:
    rows = [
        f"""SELECT '{c}' AS "column", {lo}::DOUBLE AS lo, {hi}::DOUBLE AS hi,
        count(*) FILTER (WHERE {c} < {lo}::DOUBLE OR {c} > {hi}::DOUBLE) AS invalid FROM lineitem"""
        for c, (lo, hi) in ITEM_RULES.items()
    ]
    return f"""WITH a AS ({' UNION ALL '.join(rows)}),
    b AS (SELECT * FROM a UNION ALL
          SELECT 'TOTAL', NULL, NULL, CAST(sum(invalid) AS BIGINT) FROM a)
    SELECT *, CASE WHEN invalid = 0 THEN 'CLEAN' ELSE invalid || ' invalid' END AS status FROM b"""


def histogram(table: str, columns, bins: int = 50) -> str:
    one = f"""SELECT '{{c}}' AS "column", CAST(b.bin AS BIGINT) AS bin, {r6('lo + b.bin * w', 'lower')},
      {r6(f'CASE WHEN b.bin = {bins - 1} THEN hi ELSE lo + (b.bin + 1) * w END', 'upper')},
      count(v.bin) AS n
      FROM (SELECT min({{c}}) AS lo, max({{c}}) AS hi, (max({{c}}) - min({{c}})) / {bins} AS w FROM {table}) s
      CROSS JOIN (SELECT range AS bin FROM range({bins})) b
      LEFT JOIN (
        SELECT CASE WHEN x < lo + k * w THEN greatest(k - 1, 0)
                    WHEN k < {bins - 1} AND x >= lo + (k + 1) * w THEN k + 1 ELSE k END AS bin
        FROM (SELECT {{c}} AS x, lo, w,
                least(greatest(CAST(floor(({{c}} - lo) / w) AS BIGINT), 0), {bins - 1}) AS k
              FROM {table}, (SELECT min({{c}}) AS lo, (max({{c}}) - min({{c}})) / {bins} AS w FROM {table}))
      ) v ON v.bin = b.bin
      GROUP BY b.bin, lo, hi, w"""
    return each(columns, one)


def skewness() -> str:
    # the built-in function is already bias-adjusted
    return each(MEASURES, f"SELECT '{{c}}' AS \"column\", count({{c}}) AS n, {r6('skewness({c})', 'skewness')} FROM lineitem")


def correlations(table: str, columns) -> str:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    head = ", ".join(f"corr({a}, {b}) AS r{i}" for i, (a, b) in enumerate(pairs))
    rows = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, r{i} AS r FROM w" for i, (a, b) in enumerate(pairs))
    same = " UNION ALL ".join(f"SELECT '{c}' AS feature_a, '{c}' AS feature_b, 1.0::DOUBLE AS r" for c in columns)
    return f"""WITH w AS (SELECT {head} FROM {table}), p AS ({rows})
    SELECT a AS feature_a, b AS feature_b, {r6('r', 'r')} FROM p
    UNION ALL SELECT b, a, round(r, 6) + 0.0::DOUBLE FROM p UNION ALL {same}"""


WIDE = "(SELECT vec_id, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS {c}" for i, c in enumerate(DIMENSIONS)) + " FROM embeddings)"

LONG_CORRELATIONS = f"""WITH t AS (
  SELECT vec_id, d.i, embedding[d.i + 1]::DOUBLE AS x FROM embeddings CROSS JOIN (SELECT range AS i FROM range(64)) d),
p AS (SELECT 'e' || a.i AS a, 'e' || b.i AS b, corr(a.x, b.x) AS r
      FROM t a JOIN t b ON a.vec_id = b.vec_id AND a.i > b.i GROUP BY 1, 2)
SELECT a AS feature_a, b AS feature_b, {r6('r', 'r')} FROM p
UNION ALL SELECT b, a, round(r, 6) + 0.0::DOUBLE FROM p
UNION ALL SELECT DISTINCT 'e' || i, 'e' || i, 1.0::DOUBLE FROM t"""


def strong_pairs() -> str:
    columns = [*MEASURES, "net_price", "gross_price"]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    rows = " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, abs(corr({a}, {b})) AS r FROM t" for a, b in pairs)
    return f"""WITH t AS (
      SELECT *, net_price * (1 + l_tax) AS gross_price
      FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM lineitem))
    SELECT feature_a, feature_b, {r6('r', 'abs_r')} FROM ({rows}) WHERE r > 0.85"""


def boxes(table: str, columns, label: str) -> str:
    one = f"""SELECT f.class, '{{c}}' AS "column", count(t.{{c}}) AS n, {r6('q25', 'q25')}, {r6('q50', 'q50')},
      {r6('q75', 'q75')},
      {r6('min(t.{c}) FILTER (WHERE t.{c} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25))', 'whisker_low')},
      {r6('max(t.{c}) FILTER (WHERE t.{c} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25))', 'whisker_high')},
      count(*) FILTER (WHERE t.{{c}} < q25 - 1.5 * (q75 - q25) OR t.{{c}} > q75 + 1.5 * (q75 - q25)) AS n_outliers
      FROM (SELECT {label} AS class, quantile_cont({{c}}, 0.25) AS q25, quantile_cont({{c}}, 0.5) AS q50,
                   quantile_cont({{c}}, 0.75) AS q75 FROM {table} GROUP BY 1) f
      JOIN {table} t ON t.{label} = f.class GROUP BY f.class, q25, q50, q75"""
    return each(columns, one)


VIOLIN = f"""WITH m AS (
  SELECT event_type AS class, count(value) AS n, stddev_samp(value) * pow(count(value)::DOUBLE, -0.2::DOUBLE) AS h,
         min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
         quantile_cont(value, 0.75) AS q75 FROM events GROUP BY 1),
g AS (SELECT *, lo - 2 * h AS s, (hi - lo + 4 * h) / 99 AS step FROM m),
v AS (SELECT event_type AS class, value, count(*) AS k FROM events GROUP BY 1, 2),
p AS (SELECT g.*, CAST(range AS INTEGER) AS point, s + range * step AS spot FROM g CROSS JOIN range(100))
SELECT p.class, 'value' AS "column", point, {r6('spot', 'x')},
  {r6('sum(k * exp(-0.5 * ((spot - value) / h) * ((spot - value) / h))) * 0.3989422804014327::DOUBLE / (n * h)', 'density')},
  {r6('q25', 'q25')}, {r6('q50', 'q50')}, {r6('q75', 'q75')}
FROM p JOIN v ON p.class = v.class GROUP BY p.class, point, spot, n, h, q25, q50, q75"""


def variance_shares() -> str:
    rows = each(DIMENSIONS, "SELECT '{c}' AS feature, {i} AS ordinal, var_pop({c}) AS v FROM t")
    return f"""t AS {WIDE}, spread AS ({rows}),
    shares AS (SELECT feature, ordinal, v / (SELECT sum(v) FROM spread) AS importance FROM spread)"""


ALL_VECTORS = "vec AS (SELECT vec_id, CAST(label AS BIGINT) AS label, embedding::DOUBLE[] AS e FROM embeddings)"

# from here on ``vec`` is the table that is oversampled
NEAR = f"""near AS (
  SELECT id, neighbour, distance2, row_number() OVER (PARTITION BY id ORDER BY distance2, neighbour) AS rank
  FROM (SELECT a.vec_id AS id, b.vec_id AS neighbour, {SQUARED} AS distance2
        FROM vec a JOIN vec b ON a.label = b.label AND a.vec_id <> b.vec_id))"""

GROWTH = """before AS (SELECT label AS class, count(*) AS n FROM vec GROUP BY 1),
plan AS (SELECT class, n, (SELECT max(n) FROM before) AS target FROM before)"""

SMOTE_KEY = ("class", "j")
SMOTE = f"""{NEAR}, {GROWTH},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY {digest('smote-order', 'vec_id')}, vec_id) - 1 AS idx
  FROM vec),
draws AS (
  SELECT class, j, row_number() OVER (ORDER BY CAST(class AS VARCHAR), j) - 1 AS no,
         {draw_int('smote-row', *SMOTE_KEY)} % n AS idx, {draw_int('smote-neighbour', *SMOTE_KEY)} % 5 + 1 AS rank,
         {draw_unit('smote-gap', *SMOTE_KEY)} AS gap
  FROM (SELECT class, n, unnest(range(target - n)) AS j FROM plan WHERE target > n)),
made AS (
  SELECT (SELECT max(vec_id) FROM vec) + 1 + no AS vec_id, a.label,
         list_transform(list_zip(a.e, b.e), lambda z: z[1] + gap * (z[2] - z[1])) AS e, a.vec_id AS base_id,
         CAST(j AS BIGINT) AS synthetic_no
  FROM draws JOIN numbered a ON a.label = draws.class AND a.idx = draws.idx
  JOIN near ON near.id = a.vec_id AND near.rank = draws.rank JOIN vec b ON b.vec_id = near.neighbour),
grown AS (
  SELECT *, true AS is_synthetic FROM made
  UNION ALL SELECT vec_id, label, e, vec_id, NULL, false FROM vec)"""


def smote() -> str:
    shown = ", ".join(r6(f"e[{i + 1}]", c) for i, c in enumerate(DIMENSIONS))
    return f"WITH {ALL_VECTORS}, {SMOTE} SELECT vec_id, label, {shown}, base_id, synthetic_no, is_synthetic FROM grown"


def votes(k: int, near: str = "close", by: str = "id, label") -> str:
    """The label that most of the first k neighbours have, the smallest on a tie."""
    return f"""SELECT {by}, vote AS prediction FROM (
      SELECT {by}, vote, row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, vote) AS place
      FROM {near} WHERE rank <= {k} GROUP BY {by}, vote) WHERE place = 1"""


# from ``predicted`` (model, label, prediction) to ``metrics``
METRICS = """cells AS (SELECT model, label, prediction, count(*) AS n FROM predicted GROUP BY ALL),
seen AS (SELECT DISTINCT model, label AS class FROM cells UNION SELECT DISTINCT model, prediction FROM cells),
marks AS (
  SELECT model, class,
    (SELECT coalesce(sum(n), 0) FROM cells c WHERE c.model = seen.model AND c.label = class)::DOUBLE AS support,
    (SELECT coalesce(sum(n), 0) FROM cells c WHERE c.model = seen.model AND c.prediction = class)::DOUBLE AS named,
    (SELECT coalesce(sum(n), 0) FROM cells c WHERE c.model = seen.model AND c.label = class AND c.prediction = class)::DOUBLE AS hits
  FROM seen),
report AS (
  SELECT model, class, CASE WHEN named = 0 THEN 0 ELSE hits / named END AS p,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r, 2 * hits / (named + support) AS f, support FROM marks),
metrics AS (
  SELECT model, avg(f) AS macro_f1, sum(f * support) / sum(support) AS weighted_f1,
         sum(r * support) / sum(support) AS accuracy FROM report GROUP BY 1)"""

CLOSE = f"""close AS (
  SELECT id, label, vote, row_number() OVER (PARTITION BY id ORDER BY distance2, neighbour) AS rank
  FROM (SELECT a.vec_id AS id, a.label, b.vec_id AS neighbour, b.label AS vote, {SQUARED} AS distance2
        FROM asked a CROSS JOIN held b))"""

KNN = f"""{VECTOR_SPLIT},
asked AS (SELECT * FROM parted WHERE split = 'test'), held AS (SELECT * FROM parted WHERE split = 'train'), {CLOSE},
predicted AS ({' UNION ALL '.join(f"SELECT 'knn_{k}' AS model, * FROM ({votes(k)})" for k in K_VALUES)}),
{METRICS}"""

GROWN_KNN = f"""{VECTOR_SPLIT}, vec AS (SELECT vec_id, label, e FROM parted WHERE split = 'train'), {SMOTE},
asked AS (SELECT * FROM parted WHERE split = 'test'), held AS (SELECT * FROM grown), {CLOSE}"""

SEARCH = f"""WITH {VECTOR_SPLIT},
dealt AS (
  SELECT vec_id, label, e,
    (row_number() OVER (PARTITION BY label ORDER BY {digest('fold', 'vec_id')}, vec_id) - 1) % 3 AS fold
  FROM parted WHERE split = 'train'),
close AS (
  SELECT id, fold, label, vote, row_number() OVER (PARTITION BY id ORDER BY distance2, neighbour) AS rank
  FROM (SELECT a.vec_id AS id, a.fold, a.label, b.vec_id AS neighbour, b.label AS vote, {SQUARED} AS distance2
        FROM dealt a JOIN dealt b ON a.fold <> b.fold)),
predicted AS ({' UNION ALL '.join(f"SELECT {k} || '-' || fold AS model, * FROM ({votes(k, by='id, fold, label')})" for k in SEARCHED)}),
{METRICS}
SELECT CAST(split_part(model, '-', 1) AS BIGINT) AS k, {r6('avg(macro_f1)', 'cv_macro_f1')} FROM metrics GROUP BY 1"""

SEASON_SPLIT = split_ctes(
    f"""SELECT o_orderkey, month(o_orderdate) AS month,
      CAST(CASE WHEN month(o_orderdate) <= {SEASON_ENDS[0]} THEN 0 WHEN month(o_orderdate) <= {SEASON_ENDS[1]} THEN 1 ELSE 2 END
           AS BIGINT) AS label FROM orders""",
    "label", "o_orderkey", 0.2,
)
# what a model that has found the bands of the month says
SEASONS = f"WITH {SEASON_SPLIT} SELECT o_orderkey, label, label AS prediction FROM parted WHERE split = 'test'"

STUMP = f"""{SEASON_SPLIT},
cuts AS (SELECT CAST(range AS INTEGER) AS cut FROM range(1, 12)),
sides AS (SELECT cut, month > cut AS side, label, count(*)::DOUBLE AS n
          FROM parted CROSS JOIN cuts WHERE split = 'train' GROUP BY ALL),
best AS (SELECT cut FROM (SELECT cut, side, sum(n * n) / sum(n) AS s FROM sides GROUP BY ALL)
         GROUP BY cut ORDER BY sum(s) DESC, cut LIMIT 1),
larger AS (SELECT side, label FROM (
  SELECT side, label, row_number() OVER (PARTITION BY side ORDER BY n DESC, label) AS place
  FROM sides WHERE cut = (SELECT cut FROM best)) WHERE place = 1),
stump AS (SELECT p.o_orderkey, p.label, l.label AS prediction FROM parted p
          JOIN larger l ON l.side = (p.month > (SELECT cut FROM best)) WHERE p.split = 'test')"""


NOISY = """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 3 ELSE band END AS BIGINT) AS label,
      CAST(band AS BIGINT) AS band, CAST(month AS BIGINT) AS month, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
      CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS weekday
    FROM (SELECT *, month(o_orderdate) AS month, CASE WHEN month(o_orderdate) <= 5 THEN 0
      WHEN month(o_orderdate) <= 9 THEN 1 ELSE 2 END AS band FROM orders)"""


def first_round(eta: float = 0.3) -> str:
    """Trees of depth 2 from the gradients of equal chances, by sums over the values of each feature."""
    value = f"-{eta}::DOUBLE * g / (h + 1)"

    def level(n: int) -> str:
        """CTEs that cut the nodes of ``at{n}`` and give ``at{n + 1}``."""
        return f"""
    by{n} AS (SELECT class, path, f, v, sum(g) AS g, sum(h) AS h FROM at{n} JOIN long USING (o_orderkey) GROUP BY ALL),
    run{n} AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER p AS ga, sum(h) OVER p AS ha FROM by{n}
      WINDOW w AS (PARTITION BY class, path, f ORDER BY v), p AS (PARTITION BY class, path, f)),
    gain{n} AS (SELECT *, round(gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1), 7) AS gain
      FROM run{n} WHERE hl >= 1 AND ha - hl >= 1),
    cut{n} AS (SELECT class, path, f, (SELECT min(v) FROM long l WHERE l.f = b.f AND l.v > b.v) AS threshold
      FROM (SELECT *, row_number() OVER (PARTITION BY class, path ORDER BY gain DESC, f, v) AS place FROM gain{n} WHERE gain > 0) b
      WHERE place = 1),
    at{n + 1} AS (SELECT class, path || CASE WHEN v >= threshold THEN 'R' ELSE 'L' END AS path, o_orderkey, g, h
      FROM at{n} JOIN cut{n} USING (class, path) JOIN long USING (o_orderkey, f))"""

    nodes = " UNION ALL ".join(f"SELECT class, path, sum(g) AS g, sum(h) AS h FROM at{n} GROUP BY ALL" for n in range(3))
    return f"""WITH noisy AS ({NOISY}),
    long AS (SELECT o_orderkey, 0 AS f, month AS v FROM noisy UNION ALL SELECT o_orderkey, 1, priority FROM noisy
      UNION ALL SELECT o_orderkey, 2, weekday FROM noisy),
    at0 AS (SELECT class, '' AS path, o_orderkey, 1.0::DOUBLE / 3 - CAST(label = class AS INTEGER) AS g, 4.0::DOUBLE / 9 AS h
      FROM noisy CROSS JOIN (SELECT unnest([0, 1, 2])::BIGINT AS class)),
    {level(0)}, {level(1)}, nodes AS ({nodes}), cuts AS (SELECT * FROM cut0 UNION ALL SELECT * FROM cut1)
    SELECT class, path, ['month', 'priority', 'weekday'][f + 1] AS feature, {r6('threshold', 'threshold')}, {r6(value, 'value')}
    FROM nodes LEFT JOIN cuts USING (class, path)"""


def shallow_tree(result: str) -> str:
    """Two levels of the cuts with the greatest Gini gain, then the most frequent label of each leaf."""

    def level(n: int) -> str:
        return f"""
    by{n} AS (SELECT path, f, v, label, count(*)::DOUBLE AS n FROM at{n} JOIN long USING (o_orderkey) WHERE split = 'train' GROUP BY ALL),
    ends{n} AS (SELECT DISTINCT path, f, v AS cut FROM by{n}),
    sides{n} AS (SELECT b.path, b.f, cut, v > cut AS side, label, sum(n) AS n FROM by{n} b JOIN ends{n} e ON e.path = b.path AND e.f = b.f GROUP BY ALL),
    score{n} AS (SELECT path, f, cut, sum(s) AS score, count(*) AS sides FROM
      (SELECT path, f, cut, side, sum(n * n) / sum(n) AS s FROM sides{n} GROUP BY ALL) GROUP BY ALL),
    cut{n} AS (SELECT path, f, cut, score FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY round(score, 6) DESC, f, cut) AS place
      FROM score{n} WHERE sides = 2) WHERE place = 1),
    whole{n} AS (SELECT path, sum(n * n) / sum(n) AS s FROM
      (SELECT path, label, count(*)::DOUBLE AS n FROM at{n} WHERE split = 'train' GROUP BY ALL) GROUP BY path),
    at{n + 1} AS (SELECT a.* REPLACE (a.path || CASE WHEN l.v > c.cut THEN 'R' ELSE 'L' END AS path)
      FROM at{n} a JOIN cut{n} c ON c.path = a.path JOIN long l ON l.o_orderkey = a.o_orderkey AND l.f = c.f)"""

    return f"""WITH {split_ctes(NOISY, 'label', 'o_orderkey', 0.2)},
    long AS (SELECT o_orderkey, 0 AS f, month AS v FROM parted UNION ALL SELECT o_orderkey, 1, priority FROM parted
      UNION ALL SELECT o_orderkey, 2, weekday FROM parted),
    at0 AS (SELECT o_orderkey, label, split, '' AS path FROM parted),
    {level(0)}, {level(1)},
    leaf AS (SELECT path, label AS prediction FROM (SELECT path, label, row_number() OVER (PARTITION BY path ORDER BY count(*) DESC, label) AS place
      FROM at2 WHERE split = 'train' GROUP BY path, label) WHERE place = 1)
    {result}"""


SHALLOW_PREDICTIONS = "SELECT o_orderkey, label, prediction FROM at2 JOIN leaf USING (path) WHERE split = 'test'"
SHALLOW_IMPORTANCES = f"""
    , gains AS (SELECT f, score - s AS gain FROM cut0 JOIN whole0 USING (path) UNION ALL
      SELECT f, score - s FROM cut1 c JOIN whole1 USING (path) JOIN leaf l ON l.path = c.path || 'L' JOIN leaf r ON r.path = c.path || 'R'
      WHERE l.prediction <> r.prediction)
    SELECT ['month', 'priority', 'weekday'][f + 1] AS feature,
      {r6('coalesce((SELECT sum(gain) FROM gains g WHERE g.f = x.f), 0) / (SELECT sum(gain) FROM gains)', 'importance')}
    FROM (SELECT unnest([0, 1, 2]) AS f) x"""


def two_levels(trees: int = 4, width: int = 64, kept: int = 8) -> str:
    """Cuts of the roots and of their children: drawn features, drawn cuts, the best Gini gain."""
    key = ("tree", "path", "feature")

    def level(n: int) -> str:
        return f"""
    mixed{n} AS (SELECT tree, path FROM at{n} GROUP BY ALL HAVING count(DISTINCT label) > 1),
    here{n} AS (SELECT tree, path, id, label, feature, x FROM at{n} JOIN mixed{n} USING (tree, path) JOIN long USING (id)),
    spans{n} AS (SELECT tree, path, feature, min(x) AS lo, max(x) AS hi FROM here{n} GROUP BY ALL),
    drawn{n} AS (SELECT *, row_number() OVER (PARTITION BY tree, path ORDER BY {digest('feature', *key)}) - 1 AS slot,
      lo + {draw_unit('cut', *key)} * (hi - lo) AS cut FROM spans{n} WHERE lo < hi),
    cuts{n} AS (SELECT tree, path, feature, slot, CASE WHEN cut > lo THEN cut ELSE hi END AS threshold FROM drawn{n} WHERE slot < {kept}),
    counted{n} AS (SELECT tree, path, feature, slot, threshold, x >= threshold AS side, label, count(*)::DOUBLE AS n
      FROM cuts{n} JOIN here{n} USING (tree, path, feature) GROUP BY ALL),
    scores{n} AS (SELECT tree, path, feature, slot, threshold, sum(s) AS score FROM
      (SELECT tree, path, feature, slot, threshold, side, sum(n * n) / sum(n) AS s FROM counted{n} GROUP BY ALL) GROUP BY ALL),
    best{n} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, path ORDER BY score DESC, slot) AS place FROM scores{n}) WHERE place = 1),
    at{n + 1} AS (SELECT tree, 2 * path + CAST(x >= threshold AS INTEGER) AS path, id, label FROM best{n} JOIN here{n} USING (tree, path, feature))"""

    return f"""WITH vec AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS label, embedding::DOUBLE[] AS e FROM embeddings),
    long AS (SELECT id, f.feature, e[f.feature + 1] AS x FROM vec CROSS JOIN (SELECT range AS feature FROM range({width})) f),
    at0 AS (SELECT tree, CAST(1 AS BIGINT) AS path, id, label FROM vec CROSS JOIN (SELECT range AS tree FROM range({trees})) t),
    {level(0)}, {level(1)}
    SELECT tree, path, feature, {r6('threshold', 'threshold')} FROM (SELECT * FROM best0 UNION ALL SELECT * FROM best1)"""


def first_cut(trees: int = 8, width: int = 64, kept: int = 8) -> str:
    key = ("tree", "path", "feature")
    return f"""WITH vec AS (SELECT CAST(label AS BIGINT) AS label, embedding::DOUBLE[] AS e FROM embeddings),
    long AS (SELECT label, f.feature, e[f.feature + 1] AS x FROM vec CROSS JOIN (SELECT range AS feature FROM range({width})) f),
    spans AS (SELECT t.tree, 1 AS path, feature, min(x) AS lo, max(x) AS hi
              FROM long CROSS JOIN (SELECT range AS tree FROM range({trees})) t GROUP BY ALL),
    drawn AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY {digest('feature', *key)}) - 1 AS slot,
                     lo + {draw_unit('cut', *key)} * (hi - lo) AS cut FROM spans WHERE lo < hi),
    cuts AS (SELECT tree, feature, slot, CASE WHEN cut > lo THEN cut ELSE hi END AS threshold FROM drawn WHERE slot < {kept}),
    counted AS (SELECT tree, c.feature, slot, threshold, x >= threshold AS side, label, count(*)::DOUBLE AS n
                FROM cuts c JOIN long USING (feature) GROUP BY ALL),
    sides AS (SELECT tree, feature, slot, threshold, side, sum(n * n) / sum(n) AS s FROM counted GROUP BY ALL),
    scores AS (SELECT tree, feature, slot, threshold, sum(s) AS score FROM sides GROUP BY ALL),
    best AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY score DESC, slot) AS place FROM scores)
    SELECT tree, feature, {r6('threshold', 'threshold')} FROM best WHERE place = 1"""


def oracle_sql() -> dict[str, str]:
    cats = "(SELECT DISTINCT p_type FROM part WHERE p_size > 25)"
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    hot = ", ".join(f"CASE WHEN p_type = '{t}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"p_type_{t}\"" for t in types)
    statuses = ", ".join(f"count(*) FILTER (WHERE l_linestatus = '{s}') AS \"{s}\"" for s in ["F", "O"])
    impossible = " AND ".join(f"{c} >= {lo} AND {c} <= {hi}" for c, (lo, hi) in PART_RULES.items())
    baselines = ", ".join(f"('{m}', {v}::DOUBLE)" for m, v in BASELINES)
    negatives = """SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0) AS n_negative,
      CASE WHEN count(*) FILTER (WHERE {c} < 0) = 0 THEN 'CLEAN'
           ELSE count(*) FILTER (WHERE {c} < 0) || ' negatives' END AS status FROM customer"""
    return {
        "profile_shape": "SELECT count(*) AS n_rows, 11::BIGINT AS n_columns FROM lineitem",
        "profile_head": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
        "profile_tail": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5",
        "profile_describe": describe(),
        "profile_missing": each(
            ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES, "l_returnflag", "l_linestatus", "l_shipdate"],
            "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM lineitem",
        ),
        "profile_non_null": each(
            ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
            "SELECT '{c}' AS \"column\", count({c}) AS non_null FROM customer",
        ),
        "profile_duplicates": """SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (
            SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
        "profile_value_counts": "SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1",
        "profile_balance_ratio": f"""SELECT max(n) AS largest, min(n) AS smallest, {r6('max(n) / min(n)', 'ratio')}
            FROM (SELECT count(*) AS n FROM labels GROUP BY quality)""",
        "profile_distinct_values": "SELECT DISTINCT p_type AS value FROM part",
        "profile_distinct_counts": each(
            ["p_brand", "p_type", "p_size"], "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM part"
        ),
        "profile_ranges": each(
            MEASURES, f"""SELECT '{{c}}' AS "column", {r6('min({c})', '"min"')}, {r6('max({c})', '"max"')} FROM lineitem"""
        ),
        "profile_negatives": each(["c_acctbal", "c_nationkey"], negatives),
        "profile_count_equal": "SELECT count(*) AS n FROM part WHERE p_size = 50",
        "profile_class_distribution": f"""SELECT quality AS class, count(*) AS "count",
            {r6('count(*) / (SELECT count(*) FROM labels) * 100', 'pct')} FROM labels GROUP BY 1""",
        "profile_compare_distributions": f"""WITH b AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
            a AS (SELECT event_type, count(*) AS n FROM events WHERE value >= 5.0 GROUP BY 1)
            SELECT event_type AS class, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after,
              {r6('coalesce(a.n / (SELECT sum(n) FROM a) * 100, 0)', 'pct_after')},
              coalesce(a.n, 0) - coalesce(b.n, 0) AS added,
              CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 'unchanged' ELSE 'resampled' END AS status
            FROM b FULL JOIN a USING (event_type)""",
        "profile_minorities": """SELECT quality AS class, count(*) AS "count", count(*) < 100 AS is_minority
            FROM labels GROUP BY 1""",
        "clean_invert_class_map": f"WITH {CODES} SELECT name, code FROM codes",
        "clean_unknown_labels": f"""WITH {CODES} SELECT DISTINCT o_orderpriority AS name FROM orders
            WHERE o_orderpriority NOT IN (SELECT name FROM codes WHERE code <= 3)""",
        "clean_encode_label": f"""WITH {CODES} SELECT o_orderkey, o_orderpriority, code
            FROM orders LEFT JOIN codes ON o_orderpriority = name""",
        "clean_decode_label": f"""WITH {CODES} SELECT o_orderkey, code, name
            FROM orders LEFT JOIN codes ON o_orderpriority = name""",
        "clean_recode": "SELECT p_partkey, CASE WHEN p_size = 50 THEN 0 ELSE p_size END AS p_size FROM part",
        "clean_audit_ranges": audit(),
        "clean_drop_impossible": f"SELECT p_partkey, p_size, p_retailprice FROM part WHERE {impossible}",
        "label_distribution": f"""WITH {CODES}, o AS (
              SELECT CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END || '-' || code AS pair
              FROM orders LEFT JOIN codes ON o_orderpriority = name)
            SELECT pair AS class, count(*) AS "count", {r6('count(*) / (SELECT count(*) FROM o) * 100', 'pct')}
            FROM o GROUP BY 1""",
        "split_stratified": f"WITH {ORDERS_SPLIT} SELECT * FROM parted",
        "split_imbalanced": f"""WITH {split_ctes('SELECT doc_id, quality FROM labels', 'quality', 'doc_id', 0.25)}
            SELECT * FROM parted""",
        "split_distribution": f"""WITH {ORDERS_SPLIT}, t AS (
              SELECT o_orderpriority AS class, count(*) FILTER (WHERE split = 'train') AS train,
                     count(*) FILTER (WHERE split = 'test') AS test FROM parted GROUP BY 1)
            SELECT class, train, test, {r6('train / (SELECT sum(train) FROM t) * 100', 'train_pct')},
              {r6('test / (SELECT sum(test) FROM t) * 100', 'test_pct')} FROM t""",
        "feature_circular": f"""SELECT o_orderkey,
              {r6('sin(radians(dayofyear(o_orderdate) * 360.0::DOUBLE / 366.0::DOUBLE))', 'day_sin')},
              {r6('cos(radians(dayofyear(o_orderdate) * 360.0::DOUBLE / 366.0::DOUBLE))', 'day_cos')} FROM orders""",
        "feature_formulas": f"""SELECT l_orderkey, l_quantity, {r6('l_discount', 'l_discount', 9)}, {r6('l_tax', 'l_tax', 9)},
              {r6('sqrt(l_quantity * l_quantity + l_tax * l_tax)', 'combined', 9)},
              {r6('l_extendedprice - l_quantity', 'net', 9)},
              {r6('(l_quantity + l_discount + l_tax) / 3', 'mean_rate', 9)},
              {r6('l_quantity * l_discount', 'interaction', 9)},
              {r6('l_extendedprice / (l_quantity + 1)', 'rate_ratio', 9)} FROM lineitem""",
        "encode_fit_one_hot": f"""WITH {PART_SPLIT}
            SELECT CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS ordinal, p_brand AS category
            FROM (SELECT DISTINCT p_brand FROM parted WHERE split = 'train')""",
        "encode_one_hot": f"SELECT p_partkey, {hot} FROM part",
        "encode_unseen": """SELECT 'b_' || p_brand AS "column", count(*)::DOUBLE AS n FROM part
            WHERE p_brand IN (SELECT p_brand FROM part WHERE p_brand < 'Brand#2' AND p_size <= 25) GROUP BY 1""",
        "encode_sparse": """WITH cats AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS place
              FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 10 <> 3))
            SELECT event_id, place AS index, 1.0::DOUBLE AS value FROM events JOIN cats USING (user_id)""",
        "encode_align_rows": f"SELECT p_partkey, p_size, {hot} FROM part",
        "encode_inverse": "SELECT p_partkey, CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) AS brand_no FROM part",
        "scale_fit": f"WITH {PART_SPLIT} " + each(
            ["p_size", "p_retailprice"],
            f"""SELECT '{{c}}' AS "column", {r6('avg({c})', 'mean')}, {r6('stddev_pop({c})', 'std')}
            FROM parted WHERE split = 'train'""",
        ),
        "scale_apply": f"""WITH {PART_SPLIT}, m AS (
              SELECT avg(p_size) AS m1, stddev_pop(p_size) AS s1, avg(p_retailprice) AS m2, stddev_pop(p_retailprice) AS s2
              FROM parted WHERE split = 'train')
            SELECT p_partkey, split, {r6('(p_size - m1) / s1', 'p_size')},
              {r6('(p_retailprice - m2) / s2', 'p_retailprice')} FROM parted CROSS JOIN m""",
        "expect_no_missing": f"""SELECT 'no missing values' AS "check", n = 0 AS passed, CAST(n AS VARCHAR) AS observed,
              '0' AS expected FROM (SELECT count(*) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in MEASURES)}) AS n
              FROM lineitem)""",
        "expect_together": " UNION ALL ".join([
            f"""SELECT 'no missing values' AS "check", n = 0 AS passed, CAST(n AS VARCHAR) AS observed, '0' AS expected
              FROM (SELECT {' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in MEASURES)} AS n FROM lineitem)""",
            *[f"""SELECT '{c} in range', n = 0, n || ' outside', '[{lo}, {hi}]'
              FROM (SELECT count(*) FILTER (WHERE {c} NOT BETWEEN {lo!r}::DOUBLE AND {hi!r}::DOUBLE) AS n FROM lineitem)"""
              for c, (lo, hi) in ITEM_RULES.items()],
            "SELECT 'row count', count(*) = 60000, CAST(count(*) AS VARCHAR), '60000' FROM lineitem",
        ]),
        "expect_in_range": """SELECT 'p_size in range' AS "check", n = 0 AS passed, n || ' outside' AS observed,
              '[1, 50]' AS expected FROM (SELECT count(*) FILTER (WHERE p_size NOT BETWEEN 1 AND 50) AS n FROM part)
            UNION ALL SELECT 'c_acctbal in range', n = 0, n || ' outside', '[0, 10000]'
            FROM (SELECT count(*) FILTER (WHERE c_acctbal NOT BETWEEN 0 AND 10000) AS n FROM customer)""",
        "expect_row_count": """SELECT 'row count' AS "check", count(*) = 10000 AS passed,
              CAST(count(*) AS VARCHAR) AS observed, '10000' AS expected FROM events""",
        "explore_histogram": histogram("lineitem", ["l_extendedprice", "l_discount"]),
        "explore_histogram_skewed": histogram("events", ["value"]),
        "explore_skewness": skewness(),
        "explore_correlations": correlations("lineitem", MEASURES),
        "explore_correlations_wide": LONG_CORRELATIONS,
        "explore_strong_pairs": strong_pairs(),
        "explore_box_statistics": boxes("events", ["value"], "event_type"),
        "explore_box_statistics_items": boxes("lineitem", MEASURES, "l_returnflag"),
        "explore_violin": VIOLIN,
        "explore_cross_tab": f'SELECT l_returnflag AS "row", {statuses} FROM lineitem GROUP BY 1',
        "explore_cross_tab_percent": f"""SELECT lang AS "row", source AS col, count(*) AS n,
              {r6('count(*) / sum(count(*)) OVER (PARTITION BY lang) * 100', 'pct')} FROM documents GROUP BY 1, 2""",
        "explore_indicator_counts": "SELECT 'p_brand_' || p_brand AS \"column\", count(*)::DOUBLE AS n FROM part GROUP BY 1",
        "explore_sparse_indicators": """SELECT 'p_brand_' || p_brand AS "column", count(*)::DOUBLE AS n,
              count(*) < 70 AS is_extreme FROM part GROUP BY 1
            HAVING count(*) < (SELECT count(*) FROM part) * 0.04::DOUBLE""",
        "explore_sparse_categories": f"""SELECT user_id AS value, count(*) AS n,
              {r6('count(*) / (SELECT count(*) FROM events) * 100', 'pct')}, count(*) < 60 AS is_extreme
            FROM events GROUP BY 1 HAVING count(*) / (SELECT count(*) FROM events) * 100 < {0.0065 * 100!r}::DOUBLE""",
        "select_ranking": f"""WITH {variance_shares()}
            SELECT feature, {r6('importance', 'importance')},
              CASE WHEN importance >= {1 / 64!r}::DOUBLE THEN 'keep' ELSE 'drop' END AS decision
            FROM shares ORDER BY shares.importance DESC, ordinal LIMIT 30""",
        "select_by_threshold": f"""WITH {variance_shares()}
            SELECT feature, {r6('importance', 'importance')}, importance >= {1 / 64!r}::DOUBLE AS selected FROM shares""",
        "select_dropped": f"""WITH {variance_shares()}
            SELECT feature, {r6('importance', 'importance')} FROM shares WHERE shares.importance < {1 / 64!r}::DOUBLE""",
        "resample_plan": f"WITH {ALL_VECTORS}, {GROWTH} SELECT class, n, target, target - n AS to_add FROM plan",
        "resample_neighbors": f"""WITH {ALL_VECTORS}, {NEAR} SELECT id, CAST(rank AS INTEGER) AS rank, neighbour,
              {r6('distance2', 'distance2')} FROM near WHERE near.rank <= 5""",
        "resample_smote": smote(),
        "resample_comparison": f"""WITH {ALL_VECTORS}, {SMOTE},
              after AS (SELECT label AS class, count(*) AS n FROM grown GROUP BY 1)
            SELECT class, before.n AS n_before, after.n AS n_after,
              {r6('after.n / (SELECT sum(n) FROM after) * 100', 'pct_after')}, after.n - before.n AS added,
              CASE WHEN after.n = before.n THEN 'unchanged' ELSE 'resampled' END AS status
            FROM before JOIN after USING (class)""",
        "expect_class_targets": f"""WITH {ALL_VECTORS}, {SMOTE},
              after AS (SELECT label AS class, count(*) AS n FROM grown GROUP BY 1)
            SELECT 'class ' || class AS "check", after.n = target AS passed, CAST(after.n AS VARCHAR) AS observed,
              CAST(target AS VARCHAR) AS expected FROM plan JOIN after USING (class)""",
        "knn_on_oversampled": f"WITH {GROWN_KNN} {votes(5)}",
        "train_logistic_regression": SEASONS,
        "train_decision_tree": SEASONS,
        "train_random_forest": SEASONS,
        "train_extra_trees": SEASONS,
        "train_boosted_trees": SEASONS,
        "train_multinomial_boosting": f"""WITH {split_ctes(NOISY, 'label', 'o_orderkey', 0.2)}
            SELECT o_orderkey, label, band AS prediction FROM parted WHERE split = 'test'""",
        "boosting_first_round": first_round(),
        "train_stump": f"WITH {STUMP} SELECT * FROM stump",
        "train_importances": """SELECT 'month' AS first, 3::BIGINT AS n_features, 0::BIGINT AS n_negative,
              1.0::DOUBLE AS total FROM orders LIMIT 1""",
        "train_search": SEARCH,
        "model_metrics_table": f"""WITH {STUMP}, predicted AS (
              SELECT 'stump' AS model, label, prediction FROM stump
              UNION ALL SELECT m.model, label, label FROM stump
              CROSS JOIN (SELECT unnest(['logistic_regression', 'random_forest', 'extra_trees']) AS model) m),
            {METRICS} SELECT model, {r6('macro_f1', 'macro_f1')}, {r6('weighted_f1', 'weighted_f1')},
              {r6('accuracy', 'accuracy')} FROM metrics""",
        "knn_classify": f"WITH {KNN} SELECT id, label, prediction FROM predicted WHERE model = 'knn_5'",
        "evaluate_confusion": f"""WITH {KNN}, classes AS (SELECT DISTINCT class FROM seen),
              grid AS (SELECT m.model, a.class AS label, b.class AS prediction
                FROM (SELECT DISTINCT model FROM cells) m CROSS JOIN classes a CROSS JOIN classes b)
            SELECT model, label, prediction, coalesce(n, 0) AS n FROM grid LEFT JOIN cells USING (model, label, prediction)""",
        "evaluate_accuracy": f"""WITH {KNN} SELECT model, {r6('avg(CAST(label = prediction AS INTEGER))', 'accuracy')}
            FROM predicted GROUP BY 1""",
        "evaluate_class_report": f"""WITH {KNN} SELECT model, class, {r6('p', 'precision')}, {r6('r', 'recall')},
              {r6('f', 'f1')}, CAST(support AS BIGINT) AS support FROM report""",
        "evaluate_full_report": f"""WITH {KNN}, lines AS (
              SELECT model, 'class ' || class AS class, p, r, f, support FROM report
              UNION ALL SELECT model, 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM report GROUP BY 1
              UNION ALL SELECT model, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                sum(f * support) / sum(support), sum(support) FROM report GROUP BY 1)
            SELECT model, class, {r6('p', 'precision')}, {r6('r', 'recall')}, {r6('f', 'f1')},
              CAST(support AS BIGINT) AS support FROM lines""",
        "evaluate_macro": f"""WITH {KNN} SELECT model, {r6('avg(p)', 'macro_precision')}, {r6('avg(r)', 'macro_recall')},
              {r6('avg(f)', 'macro_f1')} FROM report GROUP BY 1""",
        "evaluate_weighted": f"""WITH {KNN} SELECT model,
              {r6('sum(p * support) / sum(support)', 'weighted_precision')},
              {r6('sum(r * support) / sum(support)', 'weighted_recall')},
              {r6('sum(f * support) / sum(support)', 'weighted_f1')} FROM report GROUP BY 1""",
        "evaluate_comparison": f"""WITH {KNN} SELECT model, {r6('macro_f1', 'macro_f1')},
              {r6('weighted_f1', 'weighted_f1')}, {r6('accuracy', 'accuracy')} FROM metrics""",
        "evaluate_ranking": f"""WITH {KNN}, placed AS (
              SELECT model, macro_f1, row_number() OVER (ORDER BY macro_f1 DESC, CAST(substr(model, 5) AS INTEGER)) AS rank
              FROM metrics)
            SELECT model, {r6('macro_f1', 'macro_f1')}, rank, rank = 1 AS is_champion FROM placed""",
        "evaluate_baselines": f"""WITH {KNN}, b AS (SELECT * FROM (VALUES {baselines}) AS t(model, base))
            SELECT model, {r6('macro_f1', 'macro_f1')}, {r6('coalesce(base, 0)', 'baseline')},
              {r6('macro_f1 - coalesce(base, 0)', 'delta')} FROM metrics LEFT JOIN b USING (model)""",
        "expect_metric_floor": f"""WITH {KNN} SELECT model || ' macro_f1' AS "check", macro_f1 > 0.06 AS passed,
              printf('%.4f', macro_f1) AS observed, '> 0.06' AS expected FROM metrics""",
        "extra_trees_first_cut": first_cut(),
        "extra_trees_two_levels": two_levels(),
        "train_shallow_tree": shallow_tree(SHALLOW_PREDICTIONS),
        "train_tree_importances": shallow_tree(SHALLOW_IMPORTANCES),
        "source_round_trip": """WITH f AS (SELECT unnest(['parquet', 'csv']) AS format),
              n AS (SELECT CAST(count(*) AS VARCHAR) AS n,
                CAST(count(*) FILTER (WHERE o_orderkey IS NULL OR o_custkey IS NULL OR o_orderstatus IS NULL
                  OR o_totalprice IS NULL OR o_orderdate IS NULL OR o_orderpriority IS NULL) AS VARCHAR) AS m FROM orders),
              c AS (SELECT string_agg(column_name, ',' ORDER BY column_index) AS names
                FROM duckdb_columns() WHERE table_name = 'orders')
            , v AS (SELECT CAST(sum(CAST('0x' || substr(md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus,
                CAST(round(o_totalprice * 100) AS BIGINT), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority)), 1, 8)
                AS BIGINT)) AS VARCHAR) AS v FROM orders)
            SELECT format, 'columns in order' AS "check", true AS passed, names AS observed, names AS expected FROM f, c
            UNION ALL SELECT format, 'rows', true, n, n FROM f, n
            UNION ALL SELECT format, 'missing values', true, m, m FROM f, n
            UNION ALL SELECT format, 'values', true, v, v FROM f, v""",
    }
