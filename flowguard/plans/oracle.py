"""DuckDB SQL twins of the catalog queries (the correctness oracle).

Each query is ``WITH <fixture stages> <final select>``; the stages mirror
``fixtures.py`` / ``flows.py`` statement by statement, written independently in
plain SQL (row_number windows instead of the bucketed cut, ``median`` instead
of the bracketed exact quantile, all-pairs neighbour search for SMOTE).
"""

from __future__ import annotations

from flowguard.plans.fixtures import FLOW_FEATURES, SEED

# Python str.strip() whitespace as an RE2 character class.
WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
NAMED = ("Flow Duration", "Total Fwd Packets", "Fwd Packet Length Max")  # present non-negative cols
R = 6  # decimals kept in DOUBLE results


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def rnd(expr: str) -> str:
    return f"round({expr}, {R})"


def strip_sql(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def norm_sql(e: str) -> str:
    s = strip_sql(f"coalesce(CAST({e} AS VARCHAR), 'nan')")
    s = f"replace(replace({s}, '  ', ' '), '-', ' ')"
    return (f"array_to_string(list_transform(regexp_extract_all({s}, '\\p{{L}}+|[^\\p{{L}}]+'), "
            f"lambda x: upper(x[1]) || lower(x[2:])), '')")


FEATS = ", ".join(qi(f) for f in FLOW_FEATURES)


def _cols(transform) -> str:
    return ", ".join(f"{transform(f)} AS {qi(f)}" for f in FLOW_FEATURES)


FLOWS = f"""
base AS (
  SELECT event_id AS row_key,
         'Day' || CAST(dayofmonth(ts) AS VARCHAR) || '-WorkingHours.pcap_ISCX.csv' AS "Day",
         CASE WHEN event_id % 101 = 0 THEN -value ELSE value END AS "Flow Duration",
         CASE WHEN event_id % 211 = 0 THEN 'abc' ELSE CAST(user_id AS VARCHAR) END AS "Total Fwd Packets",
         CASE WHEN event_id % 89 = 0 THEN CAST('inf' AS DOUBLE)
              WHEN event_id % 97 = 0 THEN CAST(NULL AS DOUBLE)
              ELSE value * user_id END AS "Flow Bytes/s",
         value * 2 + CAST(event_id % 3 AS DOUBLE) * 0.5 AS "Fwd Packet Length Max",
         CAST(0.0 AS DOUBLE) AS "Bwd PSH Flags",
         CAST(event_id % 65536 AS DOUBLE) AS "Destination Port",
         CASE WHEN event_id % 499 = 1 THEN 'Infiltration'
              WHEN event_type = 'purchase' THEN 'DoS Hulk'
              WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'FTP-Patator'
              WHEN event_type = 'error' THEN ' ftp patator'
              WHEN event_type = 'signup' AND event_id % 7 = 0 THEN 'Web Attack - XSS'
              ELSE 'BENIGN ' END AS "Label"
  FROM events),
flows_raw AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE row_key % 50 = 0),
flows_norm AS (SELECT row_key, "Day", {FEATS}, {norm_sql('"Label"')} AS "Label" FROM flows_raw),
flows_dedup AS (SELECT DISTINCT * FROM flows_norm),
flows_coerced AS (SELECT row_key, "Day",
   {_cols(lambda f: f"TRY_CAST({qi(f)} AS DOUBLE)" if f in NAMED else qi(f))}, "Label" FROM flows_dedup),
flows_nonneg AS (SELECT row_key, "Day",
   {_cols(lambda f: f"CASE WHEN {qi(f)} < 0 THEN NULL ELSE {qi(f)} END" if f in NAMED else qi(f))},
   "Label" FROM flows_coerced),
flows_clean AS (SELECT row_key, "Day",
   {_cols(lambda f: f"CASE WHEN isinf({qi(f)}) THEN NULL ELSE {qi(f)} END")}, "Label" FROM flows_nonneg),
mapping AS (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id, label
            FROM (SELECT DISTINCT "Label" AS label FROM flows_clean)),
enc AS (SELECT c.row_key, m.label_id, {", ".join("c." + qi(f) for f in FLOW_FEATURES)}
        FROM flows_clean c LEFT JOIN mapping m ON c."Label" = m.label)"""


def quota_cte(name: str, src: str, draws: str, group: str = "label_id") -> str:
    """Largest-remainder class quotas: ``draws`` is an expression of ``total``."""
    return f"""
{name}_c AS (SELECT {group}, count(*) AS n FROM {src} GROUP BY {group}),
{name}_t AS (SELECT c.*, sum(n) OVER () AS total FROM {name}_c c),
{name}_d AS (SELECT *, CAST({draws} AS BIGINT) AS draws FROM {name}_t),
{name}_f AS (SELECT *, n / total * draws AS cont, CAST(floor(n / total * draws) AS BIGINT) AS fl FROM {name}_d),
{name}_r AS (SELECT *, draws - sum(fl) OVER () AS short,
             row_number() OVER (ORDER BY cont - fl DESC, {group} ASC) AS rr FROM {name}_f),
{name} AS (SELECT {group}, n, fl + CASE WHEN rr <= short THEN 1 ELSE 0 END AS quota FROM {name}_r)"""


def h(salt: str, key: str = "row_key", seed: int = SEED) -> str:
    return f"md5('{seed}|{salt}|' || CAST({key} AS VARCHAR))"


SPLIT = FLOWS + "," + quota_cte("sq", "enc", "total - ceil(CAST(0.2 AS DOUBLE) * total)") + f""",
split AS (SELECT e.*, CASE WHEN row_number() OVER (PARTITION BY e.label_id ORDER BY {h('split', 'e.row_key')}, e.row_key)
                          <= sq.n - sq.quota THEN 'test' ELSE 'train' END AS split
          FROM enc e JOIN sq USING (label_id)),
train AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'train'),
test AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'test')"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def stratified_sample_cte(name: str, src: str, frac: float, salt: str) -> str:
    return quota_cte(f"{name}_q", src, f"total - ceil(CAST({1.0 - frac!r} AS DOUBLE) * total)") + f""",
{name} AS (SELECT s.* FROM (SELECT t.*, row_number() OVER (PARTITION BY t.label_id ORDER BY {h(salt, 't.row_key')}, t.row_key) AS _rn
                             FROM {src} t) s JOIN {name}_q q USING (label_id) WHERE s._rn <= q.quota)"""


_F = list(FLOW_FEATURES)
_MED = ", ".join(f"median({qi(f)}) AS m{i}" for i, f in enumerate(_F))
_FILL = ", ".join(f"coalesce(t.{qi(f)}, med.m{i}) AS {qi(f)}" for i, f in enumerate(_F))
_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {i} AS pos_a, {j} AS pos_b, corr({qi(a)}, {qi(b)}) AS r FROM train_f"
    for i, a in enumerate(_F) for j, b in enumerate(_F) if i < j)
_ZV = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CASE WHEN count({qi(f)}) = 0 THEN 'all_null' "
    f"WHEN count({qi(f)}) >= 2 AND min({qi(f)}) = max({qi(f)}) THEN 'zero_variance' END AS reason, "
    f"{i} AS position FROM train_f" for i, f in enumerate(_F))
_FEAT_VALUES = ", ".join(f"('{f}', {i})" for i, f in enumerate(_F))
_UNPIV = ", ".join(qi(f) for f in _F)

PREP = SPLIT + f""",
med AS (SELECT {_MED} FROM train),
train_f AS (SELECT t.row_key, t.label_id, {_FILL} FROM train t CROSS JOIN med),
test_f AS (SELECT t.row_key, t.label_id, {_FILL} FROM test t CROSS JOIN med),
feat AS (SELECT * FROM (VALUES {_FEAT_VALUES}) v(feature, position)),
zv AS (SELECT * FROM ({_ZV}) WHERE reason IS NOT NULL),
pairs AS (SELECT * FROM ({_PAIRS})
          WHERE feature_a NOT IN (SELECT feature FROM zv) AND feature_b NOT IN (SELECT feature FROM zv)),
high AS (SELECT feature_a, feature_b, pos_a, pos_b, abs(r) AS r FROM pairs WHERE NOT isnan(r) AND abs(r) > 0.95),
red AS (SELECT DISTINCT feature_b AS feature, 'correlated' AS reason FROM high),
final_feat AS (SELECT feature, position FROM feat
               WHERE feature NOT IN (SELECT feature FROM zv) AND feature NOT IN (SELECT feature FROM red)),
train_long AS (SELECT * FROM (UNPIVOT train_f ON {_UNPIV} INTO NAME feature VALUE value)
               WHERE feature IN (SELECT feature FROM final_feat)),
test_long AS (SELECT * FROM (UNPIVOT test_f ON {_UNPIV} INTO NAME feature VALUE value)
              WHERE feature IN (SELECT feature FROM final_feat)),
binmap AS (SELECT label_id, CAST(lower(label) <> 'benign' AS INTEGER) AS label_binary FROM mapping),
imp AS (SELECT feature, abs(corr(value, CAST(b.label_binary AS DOUBLE))) AS importance
        FROM train_long JOIN binmap b USING (label_id) GROUP BY feature),
imp_rank AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank
             FROM imp WHERE NOT isnan(importance))"""
