"""Query registry: every registered query runs an engine operator over the
driver's whole tables (through the adapters), paired with an oracle SQL
string that DuckDB evaluates straight from the flat tables.

No SQL is built from data (F10): operators use column expressions and
literals; the oracle strings are fixed text. Column names and types are
aligned on both sides; arrays are rendered as
``|``-joined text (sorted where the source order is not defined).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import snapshot

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


# =====================================================================
# Snapshot transform family
# =====================================================================
SNAP = snapshot.SNAPSHOT_ID

# Shared oracle CTEs: the flat-table twin of the adapter's documents.
_SNAP_CTE = f"""
WITH ok AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, o.o_orderdate, o.o_totalprice,
         c.c_name, c.c_mktsegment, c.c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus = 'F'
),
ch AS (
  SELECT *, c_name || '/' || o_orderpriority AS character_key FROM ok
  QUALIFY row_number() OVER (PARTITION BY c_name, o_orderpriority
                             ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
),
li AS (
  SELECT ch.character_key, l.*, p.*,
    row_number() OVER (PARTITION BY l.l_orderkey
                       ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey) - 1 AS k,
    CAST(l.l_quantity AS INTEGER) % 7 AS n,
    1 + l.l_linenumber % 3 AS g,
    CAST(round(l.l_discount * 100) AS INTEGER) AS q,
    CAST(round(l.l_tax * 1000) AS INTEGER) AS r,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN NULL
         WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN 'Weapon'
         WHEN l.l_returnflag = 'A' THEN 'Weapon2'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'BodyArmour'
         WHEN l.l_returnflag = 'N' THEN 'Flask'
         ELSE 'Ring' END AS slot
  FROM ch JOIN lineitem l ON l.l_orderkey = ch.o_orderkey
          JOIN part p ON p.p_partkey = l.l_partkey
),
jw AS (
  SELECT li.*, row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS j
  FROM li WHERE p_size > 45
)"""

_SOCKETS_TEXT = """'[' || array_to_string(list_transform(range(n), lambda i:
      '{"group":' || CAST(i % g AS VARCHAR) || ',"attr":"' ||
      (CASE i % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'D' ELSE 'I' END) || '","sColour":"' ||
      (CASE i % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'G' ELSE 'B' END) || '"}'), ',') || ']'"""


def _snap(spark: SparkSession, sf_dir: str) -> snapshot.Normalised:
    return snapshot.from_tables(spark, sf_dir)


@register("characters", _SNAP_CTE + f"""
SELECT character_key, '{SNAP}' AS snapshot_id, CAST(o_custkey AS INTEGER) AS rank,
  c_name AS account, o_orderpriority AS "character", c_mktsegment AS class,
  c_mktsegment || '-' || substr(o_orderpriority, 1, 1) AS ascendancy,
  c_nationkey AS class_id, c_nationkey % 3 AS ascendancy_class, c_nationkey + 1 AS level,
  CAST(round(o_totalprice * 100) AS BIGINT) AS experience,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS fetched_at
FROM ch""")
def q_characters(spark, sf_dir):
    return _snap(spark, sf_dir).table("characters")


@register("items", _SNAP_CTE + f"""
SELECT character_key, character_key || '#' || k AS item_id, slot, p_name AS name,
  coalesce(CASE WHEN p_size % 2 = 0 THEN p_brand END, p_type) AS base_type,
  p_type AS type_line,
  CASE p_size % 4 WHEN 0 THEN 'Unique' WHEN 1 THEN 'Rare' WHEN 2 THEN 'Magic' ELSE 'Normal' END AS rarity,
  CAST(l_quantity AS INTEGER) AS ilvl,
  l_discount >= 0.05 AS corrupted,
  CASE WHEN p_size % 5 = 0 THEN '{{"shaper":true}}' END AS influences,
  CAST(CASE WHEN n = 0 THEN 0 ELSE (n + g - 1) // g END AS INTEGER) AS links,
  CASE WHEN q > 0 THEN q END AS quality,
  {_SOCKETS_TEXT} AS sockets,
  r AS req_level,
  l_tax > 0.02 AS identified,
  l_linenumber = 1 AS fractured,
  l_suppkey % 4 = 0 AS synthesised,
  false AS mirrored,
  (p_size > 40 AND l_linenumber % 2 = 0) AS split
FROM li WHERE slot IS NOT NULL
UNION ALL
SELECT character_key, character_key || '#p' || j, 'PassiveJewels', p_name,
  'Large Cluster Jewel', 'Large Cluster Jewel', 'Magic', p_size, false, NULL,
  0, NULL, NULL, NULL, false, false, false, false, false
FROM jw""")
def q_items(spark, sf_dir):
    return _snap(spark, sf_dir).table("items")


@register("item_mods", _SNAP_CTE + """
SELECT character_key, character_key || '#' || k AS item_key, 'implicit' AS mod_domain,
  '+' || CAST(l_quantity AS INTEGER) || ' to maximum Life' AS mod_text
FROM li WHERE l_linenumber % 2 = 1
UNION ALL SELECT character_key, character_key || '#' || k, 'explicit', p_brand || ' affix' FROM li
UNION ALL SELECT character_key, character_key || '#' || k, 'explicit', p_type || ' suffix' FROM li
UNION ALL SELECT character_key, character_key || '#' || k, 'crafted', 'Crafted ' || l_linestatus
  FROM li WHERE l_returnflag = 'R'
UNION ALL SELECT character_key, character_key || '#' || k, 'enchant', 'Enchant ' || p_size
  FROM li WHERE p_size > 45
UNION ALL SELECT character_key, character_key || '#' || k, 'fractured', 'Fractured ' || p_name
  FROM li WHERE l_linenumber = 1
UNION ALL SELECT character_key, character_key || '#' || k, 'veiled', 'Veiled'
  FROM li WHERE l_suppkey % 10 = 3
UNION ALL SELECT character_key, character_key || '#' || k, 'utility', 'Utility flask'
  FROM li WHERE slot = 'Flask'
UNION ALL SELECT character_key, character_key || '#p' || j, 'explicit', 'Adds ' || p_brand FROM jw""")
def q_item_mods(spark, sf_dir):
    return _snap(spark, sf_dir).table("item_mods")


_SKILLS_CTE = _SNAP_CTE + """,
gm AS (
  SELECT character_key, slot, CAST(i % g AS INTEGER) AS link_group,
    CASE WHEN i < g THEN false WHEN i = 5 THEN NULL ELSE true END AS is_support,
    CASE WHEN i < g THEN (CASE WHEN p_size % 7 = 0 THEN NULL
                               ELSE p_type || ' ' || CASE i WHEN 0 THEN 'Strike' WHEN 1 THEN 'Slam'
                                                            ELSE 'Nova' END END)
         ELSE p_brand || ' Support' END AS gem,
    CAST(1 + (i + l_linenumber) % 20 AS INTEGER) AS level,
    CAST((i * 3 + l_partkey) % 21 AS INTEGER) AS quality
  FROM li, unnest(range(n)) AS t(i)
  WHERE n > 0
),
grp AS (
  SELECT character_key, slot, link_group,
    max(CASE WHEN NOT is_support THEN gem END) AS gem,
    max(CASE WHEN NOT is_support THEN level END) AS level,
    max(CASE WHEN NOT is_support THEN quality END) AS quality,
    array_to_string(list_sort(coalesce(list(gem) FILTER (WHERE is_support), [])), '|') AS supports,
    CAST(count(*) AS INTEGER) AS link_count
  FROM gm GROUP BY character_key, slot, link_group
  HAVING max(CASE WHEN NOT is_support THEN gem END) IS NOT NULL
),
sk AS (
  SELECT *, (row_number() OVER (PARTITION BY character_key
      ORDER BY (slot IN ('Weapon', 'Weapon2', 'BodyArmour')) DESC, link_count DESC, gem, slot,
               link_group) = 1 AND slot IN ('Weapon', 'Weapon2', 'BodyArmour')) AS is_main
  FROM grp
)"""


@register("skills", _SKILLS_CTE + """
SELECT character_key, slot, link_group, gem, level, quality, supports, link_count, is_main FROM sk""")
def q_skills(spark, sf_dir):
    s = _snap(spark, sf_dir).table("skills")
    return s.withColumn("supports", F.array_join("supports", "|"))


_PASSIVES_CTE = _SNAP_CTE + """,
tree AS (SELECT p_partkey AS hash, p_name AS name, [p_type, p_brand] AS stats,
                p_size >= 48 AS is_keystone FROM part),
ta AS (SELECT character_key, CASE WHEN l_suppkey % 10 = 0 THEN l_partkey + 1000000000
                                  ELSE l_partkey END AS node_hash FROM li),
cm AS (SELECT character_key, 2000000000 + l_partkey * 10 + m AS node_hash,
              p_name || ' node ' || m AS name, ['Stat ' || m, p_type] AS stats,
              m = 0 AS is_notable
       FROM jw, unnest([0, 1, 2]) AS t(m) WHERE m <> 1 OR l_suppkey % 3 <> 0),
ca AS (SELECT character_key, 2000000000 + l_partkey * 10 + m AS node_hash
       FROM jw, unnest([0, 1]) AS t(m)),
pv AS (
  SELECT ta.character_key, ta.node_hash, t.name AS node_name,
    coalesce(t.stats, []) AS node_stats, coalesce(t.is_keystone, false) AS is_keystone,
    'tree' AS source, false AS is_notable
  FROM ta LEFT JOIN tree t ON ta.node_hash = t.hash
  UNION ALL
  SELECT ca.character_key, ca.node_hash, cm.name, coalesce(cm.stats, []), false, 'cluster',
    coalesce(cm.is_notable, false)
  FROM ca LEFT JOIN cm ON ca.character_key = cm.character_key AND ca.node_hash = cm.node_hash
)"""


@register("passives", _PASSIVES_CTE + """
SELECT character_key, node_hash, node_name, array_to_string(node_stats, '|') AS node_stats,
  is_keystone, source, is_notable FROM pv""")
def q_passives(spark, sf_dir):
    p = _snap(spark, sf_dir).table("passives")
    return p.withColumn("node_stats", F.array_join("node_stats", "|"))


@register("masteries", _SNAP_CTE + """
SELECT character_key, l_partkey * 100 + k AS node_hash, l_suppkey AS effect_hash,
  '' AS effect_stats
FROM li WHERE l_linestatus = 'F'""")
def q_masteries(spark, sf_dir):
    m = _snap(spark, sf_dir).table("masteries")
    return m.withColumn("effect_stats", F.array_join("effect_stats", "|"))


@register("raw_payloads", _SNAP_CTE + """
SELECT ch.character_key, CAST(count(l.l_orderkey) AS INTEGER) AS n_items,
  CAST(count(l.l_orderkey) AS INTEGER) AS n_hashes, true AS verbatim
FROM ch LEFT JOIN lineitem l ON l.l_orderkey = ch.o_orderkey
GROUP BY ch.character_key""")
def q_raw(spark, sf_dir):
    """The verbatim payload text per character. The text is the adapter's
    JSON rendering: every character's raw items and passives hold one entry
    per lineitem of its order, and the text is, byte for byte (by digest), one
    that the state file holds for that identity."""
    raw = _snap(spark, sf_dir).table("raw")
    state = snapshot.staged_state(spark, sf_dir).where(F.col("outcome") == "ok").select(
        F.concat_ws("/", "account", "character").alias("key"),
        F.sha2(F.concat_ws("\n", "characterData", "passiveTree"), 256).alias("digest"), F.lit(True).alias("held")).distinct()
    # The texts stay where they are: digest and lengths are what the join moves.
    raw = raw.select("character_key", F.sha2(F.concat_ws("\n", "items", "passives"), 256).alias("digest"),
                     F.json_array_length(F.get_json_object("items", "$.items")).alias("n_items"),
                     F.json_array_length(F.get_json_object("passives", "$.hashes")).alias("n_hashes"))
    raw = raw.join(state, (raw["character_key"] == state["key"]) & (raw["digest"] == state["digest"]), "left")
    return raw.select("character_key", F.coalesce("held", F.lit(False)).alias("verbatim"), "n_items", "n_hashes")


_PCT = "floor(count(*) / max(t.total) * 100 * 100 + 0.5) / 100"


@register("class_distribution", _SNAP_CTE + f"""
SELECT 'class_distribution' AS kind, c_mktsegment AS name, count(*) AS count,
  {_PCT} AS percentage, max(t.total) AS total
FROM ch, (SELECT count(*) AS total FROM ch) t
WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""")
def q_class_distribution(spark, sf_dir):
    return _snap(spark, sf_dir).aggregate("class_distribution")


@register("skill_popularity", _SKILLS_CTE + f"""
SELECT 'skill_popularity' AS kind, gem AS name, count(*) AS count,
  {_PCT} AS percentage, max(t.total) AS total
FROM sk, (SELECT count(*) AS total FROM ch) t
WHERE is_main AND gem IS NOT NULL GROUP BY gem""")
def q_skill_popularity(spark, sf_dir):
    return _snap(spark, sf_dir).aggregate("skill_popularity")


@register("unique_usage", _SNAP_CTE + """
SELECT 'unique_usage' AS kind, p_name AS name, count(DISTINCT character_key) AS count,
  floor(count(DISTINCT character_key) / max(t.total) * 100 * 100 + 0.5) / 100 AS percentage,
  max(t.total) AS total
FROM li, (SELECT count(*) AS total FROM ch) t
WHERE slot IS NOT NULL AND p_size % 4 = 0 AND p_name IS NOT NULL AND p_name <> ''
GROUP BY p_name""")
def q_unique_usage(spark, sf_dir):
    return _snap(spark, sf_dir).aggregate("unique_usage")


@register("keystone_usage", _PASSIVES_CTE + f"""
SELECT 'keystone_usage' AS kind, node_name AS name, count(*) AS count,
  {_PCT} AS percentage, max(t.total) AS total
FROM pv, (SELECT count(*) AS total FROM ch) t
WHERE is_keystone AND node_name IS NOT NULL GROUP BY node_name""")
def q_keystone_usage(spark, sf_dir):
    return _snap(spark, sf_dir).aggregate("keystone_usage")


# =====================================================================
# State family (P5-P10, J3, A1-A3, P7) and roster
# =====================================================================
from quarry.operators import aggregates as AG  # noqa: E402
from quarry.operators import roster as RO  # noqa: E402
from quarry.operators import state as ST  # noqa: E402
from quarry.plans import adapters as AD  # noqa: E402

WORKERS = 15
MAX_ATTEMPTS = 3
NOW_1 = "2024-01-01T00:00:00.000Z"
NOW_2 = "2024-02-01T00:00:00.000Z"


def _seeded(spark, sf_dir):
    """P7 over the customer roster, line 0 = highest balance."""
    roster = AD.customer_roster(spark, sf_dir)
    return ST.seed_state(roster, [F.col("c_acctbal").desc(), F.col("c_custkey").asc()])


def _merged(spark, sf_dir):
    return ST.merge_results(_seeded(spark, sf_dir), AD.event_results(spark, sf_dir))


_STATE_CTE = """
WITH st AS (
  SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS ordinal,
    CAST(c_custkey AS INTEGER) AS rank, c_name AS account, c_mktsegment AS "character",
    c_mktsegment AS class, c_nationkey AS level, 'pending' AS outcome, 0 AS attempts,
    CAST(NULL AS VARCHAR) AS fetchedAt
  FROM customer
),
res AS (
  SELECT c.c_name AS account, c.c_mktsegment AS "character",
    CASE e.event_type WHEN 'purchase' THEN 'ok' WHEN 'view' THEN 'private'
      WHEN 'signup' THEN 'dead' WHEN 'error' THEN 'retryable' WHEN 'click' THEN 'retryable' END
      AS outcome,
    CAST(1 + CAST(floor(e.value) AS INTEGER) % 3 AS INTEGER) AS attempts,
    CASE WHEN e.event_type = 'purchase' THEN strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS fetchedAt,
    'w0' || CAST(e.event_id % 2 AS VARCHAR) AS file, e.event_id AS seq
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
),
lastr AS (
  SELECT * FROM res QUALIFY row_number() OVER (PARTITION BY account, "character"
                                               ORDER BY file DESC, seq DESC) = 1
),
merged AS (
  SELECT st.ordinal, st.rank, st.account, st."character", st.class, st.level,
    CASE WHEN lastr.account IS NOT NULL THEN lastr.outcome ELSE st.outcome END AS outcome,
    CASE WHEN lastr.account IS NOT NULL THEN lastr.attempts ELSE st.attempts END AS attempts,
    CASE WHEN lastr.account IS NOT NULL THEN lastr.fetchedAt ELSE st.fetchedAt END AS fetchedAt
  FROM st LEFT JOIN lastr ON st.account = lastr.account AND st."character" = lastr."character"
)"""


@register("seed_state", _STATE_CTE + """
SELECT ordinal, rank, account, "character", class, level, outcome, attempts FROM st""")
def q_seed_state(spark, sf_dir):
    return _seeded(spark, sf_dir).select("ordinal", "rank", "account", "character", "class",
                                         "level", "outcome", "attempts")


@register("merge_results", _STATE_CTE + """
SELECT ordinal, account, "character", outcome, attempts, fetchedAt FROM merged""")
def q_merge_results(spark, sf_dir):
    return _merged(spark, sf_dir).select("ordinal", "account", "character", "outcome",
                                         "attempts", "fetchedAt")


_TALLY_SQL = """
SELECT count(*) FILTER (WHERE outcome = 'pending') AS pending,
  count(*) FILTER (WHERE outcome = 'ok') AS ok,
  count(*) FILTER (WHERE outcome = 'private') AS private,
  count(*) FILTER (WHERE outcome = 'retryable') AS retryable,
  count(*) FILTER (WHERE outcome = 'dead') AS dead,
  count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
  count(*) FILTER (WHERE outcome IN ('pending', 'retryable')) AS pending_of,
  count(*) AS total
FROM {src}"""


def _tally_with_coverage(state):
    return AG.coverage(AG.tally_outcomes(state))


@register("state_tally", _STATE_CTE + _TALLY_SQL.format(src="merged"))
def q_state_tally(spark, sf_dir):
    return _tally_with_coverage(_merged(spark, sf_dir))


@register("close_tally", _STATE_CTE + _TALLY_SQL.format(
    src="(SELECT CASE WHEN outcome IN ('pending', 'retryable') THEN 'skipped' ELSE outcome END "
        "AS outcome FROM merged) s"))
def q_close_tally(spark, sf_dir):
    return _tally_with_coverage(ST.mark_remaining_skipped(_merged(spark, sf_dir)))


@register("worker_assignment", _STATE_CTE + f"""
SELECT CAST(ordinal % {WORKERS} AS INTEGER) AS slot, count(*) AS identities,
  min(ordinal) AS first_ordinal
FROM merged WHERE outcome IN ('pending', 'retryable') GROUP BY 1""")
def q_worker_assignment(spark, sf_dir):
    pend = ST.assign(ST.pending_identities(_merged(spark, sf_dir)), WORKERS)
    return pend.groupBy("slot").agg(F.count(F.lit(1)).alias("identities"),
                                    F.min("ordinal").alias("first_ordinal"))


@register("attempt_results", _STATE_CTE + f""",
att AS (
  SELECT c.c_name AS account, c.c_mktsegment AS "character",
    CASE e.event_type WHEN 'purchase' THEN 'ok' WHEN 'view' THEN 'private'
      WHEN 'signup' THEN 'dead' WHEN 'error' THEN 'retryable' WHEN 'click' THEN 'rate_limited' END
      AS items_kind,
    CASE WHEN e.value >= 50 THEN 'retryable' ELSE 'ok' END AS passives_kind
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
  QUALIFY row_number() OVER (PARTITION BY c.c_name, c.c_mktsegment ORDER BY e.ts DESC, e.event_id DESC) = 1
),
run AS (
  SELECT m.account, m."character", m.outcome AS before_outcome, m.attempts AS before_attempts,
    CASE WHEN items_kind <> 'ok' THEN items_kind WHEN passives_kind <> 'ok' THEN passives_kind
         ELSE 'ok' END AS kind
  FROM merged m JOIN att ON m.account = att.account AND m."character" = att."character"
  WHERE m.outcome IN ('pending', 'retryable')
),
nxt AS (
  SELECT account, "character", before_outcome, before_attempts,
    CASE WHEN kind = 'rate_limited' THEN before_outcome
         WHEN kind = 'retryable' THEN CASE WHEN before_attempts + 1 >= {MAX_ATTEMPTS}
                                           THEN 'dead' ELSE 'retryable' END
         ELSE kind END AS outcome,
    CAST(CASE WHEN kind = 'rate_limited' THEN before_attempts ELSE before_attempts + 1 END
         AS INTEGER) AS attempts
  FROM run
)
SELECT account, "character", outcome, attempts FROM nxt
WHERE outcome IS DISTINCT FROM before_outcome OR attempts IS DISTINCT FROM before_attempts""")
def q_attempt_results(spark, sf_dir):
    merged = _merged(spark, sf_dir)
    attempts = latest_per_key_attempts(AD.event_attempts(spark, sf_dir))
    pend = ST.pending_identities(merged)
    run = pend.join(attempts, ["account", "character"])
    nxt = ST.next_outcome(run, MAX_ATTEMPTS)
    after = nxt.select("account", "character", F.col("next_outcome").alias("outcome"),
                       F.col("next_attempts").alias("attempts"))
    return ST.result_lines(pend, after)


def latest_per_key_attempts(att):
    from quarry.operators.common import latest_per_key
    return latest_per_key(att, ["account", "character"], ["ts", "event_id"]) \
        .select("account", "character", "items_kind", "passives_kind")


_ROSTER_CTE = f"""
WITH ent AS (
  SELECT o.o_orderkey AS pos, c.c_name AS account, o.o_orderpriority AS "character",
    c.c_mktsegment AS class, CAST(o.o_orderkey % 100 AS INTEGER) AS level,
    CAST(o.o_custkey AS INTEGER) AS rank, o.o_orderdate < TIMESTAMP '1998-01-01' AS first
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
r1 AS (
  SELECT account, "character", class, level, rank, '{NOW_1}' AS firstSeenAt, '{NOW_1}' AS lastSeenAt
  FROM ent WHERE first
  QUALIFY row_number() OVER (PARTITION BY account, "character" ORDER BY pos DESC) = 1
),
e2 AS (
  SELECT * FROM ent WHERE NOT first
  QUALIFY row_number() OVER (PARTITION BY account, "character" ORDER BY pos DESC) = 1
),
r2 AS (
  SELECT coalesce(r1.account, e2.account) AS account,
    coalesce(r1."character", e2."character") AS "character",
    CASE WHEN e2.account IS NOT NULL THEN e2.class ELSE r1.class END AS class,
    CASE WHEN e2.account IS NOT NULL THEN e2.level ELSE r1.level END AS level,
    CASE WHEN e2.account IS NOT NULL THEN e2.rank ELSE r1.rank END AS rank,
    coalesce(r1.firstSeenAt, '{NOW_2}') AS firstSeenAt,
    CASE WHEN e2.account IS NOT NULL THEN '{NOW_2}' ELSE r1.lastSeenAt END AS lastSeenAt,
    r1.account IS NULL AS is_new
  FROM r1 FULL OUTER JOIN e2 ON r1.account = e2.account AND r1."character" = e2."character"
)"""


def _rosters(spark, sf_dir):
    empty = spark.createDataFrame([], "account string, character string, class string, level int, "
                                      "rank int, firstSeenAt string, lastSeenAt string")
    r1, c1 = RO.merge_ladder(empty, AD.ladder_entries(spark, sf_dir, True), NOW_1)
    r2, c2 = RO.merge_ladder(r1, AD.ladder_entries(spark, sf_dir, False), NOW_2)
    return r2, c2


@register("merge_ladder", _ROSTER_CTE + """
SELECT account, "character", class, level, rank, firstSeenAt, lastSeenAt FROM r2""")
def q_merge_ladder(spark, sf_dir):
    return _rosters(spark, sf_dir)[0]


@register("ladder_counts", _ROSTER_CTE + """
SELECT (SELECT count(*) FROM r2 WHERE is_new) AS added,
  (SELECT count(*) FROM ent WHERE NOT first) - (SELECT count(*) FROM r2 WHERE is_new) AS refreshed""")
def q_ladder_counts(spark, sf_dir):
    return _rosters(spark, sf_dir)[1]


# =====================================================================
# Storage family
# =====================================================================
from quarry.operators import storage as SO  # noqa: E402

NOW_STORAGE = "2024-01-10T00:00:00.000Z"
KEEP_NEWEST = 2

_INV_CTE = """
WITH inv AS (
  SELECT doc_id, n_chars AS size, source AS snap, lang,
    CASE lang WHEN 'en' THEN 'Mirage' WHEN 'fr' THEN 'Hardcore Mirage' WHEN 'de' THEN 'Standard'
              WHEN 'es' THEN 'Mirage (PL1)' END AS league_name,
    doc_id % 16 AS kind
  FROM documents
),
cls AS (
  SELECT doc_id, size, lang, snap,
    CASE kind WHEN 0 THEN 'detail' WHEN 15 THEN 'detail' WHEN 1 THEN 'agg' WHEN 2 THEN 'meta'
      WHEN 3 THEN 'raw' WHEN 4 THEN 'chunk' WHEN 5 THEN 'snapshot-state' WHEN 6 THEN 'worker-result'
      WHEN 7 THEN 'roster' WHEN 8 THEN 'checkpoint' WHEN 9 THEN 'worker' WHEN 10 THEN 'ip'
      WHEN 11 THEN 'tree' WHEN 12 THEN 'economy' WHEN 13 THEN 'index' ELSE 'other' END AS category,
    CASE WHEN kind IN (0, 15, 3, 4, 5, 6) THEN league_name END AS league,
    CASE WHEN kind IN (0, 15, 3, 4, 5, 6) THEN snap END AS snapshot_id,
    league_name
  FROM inv
),
man AS (
  SELECT CASE lang WHEN 'en' THEN 'Mirage' WHEN 'fr' THEN 'Hardcore Mirage' WHEN 'de' THEN 'Standard'
              WHEN 'es' THEN 'Mirage (PL1)' END AS league,
    source AS snapshot_id, s,
    CASE WHEN s % 6 = 5 THEN 5 ELSE 6 END AS schemaVersion,
    CASE s % 5 WHEN 0 THEN 'collecting' WHEN 1 THEN 'published' WHEN 2 THEN 'transforming'
               WHEN 3 THEN 'aborted' ELSE 'ladder_capture' END AS phase,
    '2024-01-' || lpad(CAST(s + 1 AS VARCHAR), 2, '0') || 'T12:00:00.000Z' AS ladderCapturedAt,
    CASE WHEN s % 5 = 3 THEN '2024-01-' || lpad(CAST(s + 2 AS VARCHAR), 2, '0') || 'T00:00:00.000Z' END
      AS abortedAt,
    s * 10 + CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS pos
  FROM (SELECT DISTINCT lang, source, CAST(substr(source, 4) AS INTEGER) AS s FROM documents)
),
meta AS (
  SELECT league, snapshot_id,
    CASE WHEN s % 5 = 1 THEN '2024-01-' || lpad(CAST(s + 2 AS VARCHAR), 2, '0') || 'T00:00:00.000Z' END
      AS completedAt,
    CASE WHEN s % 7 = 5 THEN 'not-a-date'
         ELSE '2024-01-' || lpad(CAST(s + 2 AS VARCHAR), 2, '0') || 'T06:00:00.000Z' END AS updatedAt
  FROM man WHERE s % 7 <> 6
),
inflight AS (
  SELECT DISTINCT league, snapshot_id FROM man
  WHERE phase IN ('ladder_capture', 'collecting', 'transforming')
),
orph AS (
  SELECT * FROM cls
  WHERE category IN ('raw', 'chunk', 'snapshot-state', 'worker-result')
    AND NOT EXISTS (SELECT 1 FROM inflight i
                    WHERE i.league = cls.league AND i.snapshot_id = cls.snapshot_id)
)"""


def _classified(spark, sf_dir):
    return SO.classify_inventory(snapshot.staged_inventory(spark, sf_dir))


@register("key_parse", _INV_CTE + """
SELECT doc_id, category, league, snapshot_id, size FROM cls""")
def q_key_parse(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", "category", "league", "snapshot_id", "size")


@register("usage_by_category", _INV_CTE + """
SELECT c.category, CAST(coalesce(sum(cls.size), 0) AS BIGINT) AS bytes,
  CAST(count(cls.size) AS BIGINT) AS objects
FROM (VALUES ('index'), ('economy'), ('raw'), ('tree'), ('roster'), ('snapshot-state'),
  ('worker-result'), ('chunk'), ('worker'), ('ip'), ('checkpoint'), ('detail'), ('agg'), ('meta'),
  ('other')) AS c(category)
LEFT JOIN cls ON cls.category = c.category GROUP BY c.category""")
def q_usage_by_category(spark, sf_dir):
    return SO.usage_by_category(_classified(spark, sf_dir))


@register("snapshot_groups", _INV_CTE + """
SELECT league, snapshot_id, category, count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes
FROM cls WHERE snapshot_id IS NOT NULL GROUP BY ALL""")
def q_snapshot_groups(spark, sf_dir):
    return SO.group_by_snapshot(_classified(spark, sf_dir))


@register("orphan_sweep", _INV_CTE + """
SELECT doc_id, category, league, snapshot_id, size FROM orph""")
def q_orphan_sweep(spark, sf_dir):
    o = SO.orphans(_classified(spark, sf_dir), AD.manifests(spark, sf_dir))
    return o.select("doc_id", "category", "league", "snapshot_id", "size")


@register("legacy_sweep_plan", _INV_CTE + """
SELECT category, CASE WHEN i.league IS NULL THEN 'doomed' ELSE 'protected' END AS status,
  count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes
FROM cls LEFT JOIN inflight i ON i.league = cls.league AND i.snapshot_id = cls.snapshot_id
WHERE category IN ('chunk', 'raw') GROUP BY ALL""")
def q_legacy_sweep_plan(spark, sf_dir):
    return SO.legacy_sweep_plan(_classified(spark, sf_dir), AD.manifests(spark, sf_dir))


@register("discard_aborted", _INV_CTE + """
SELECT cls.doc_id, cls.category, cls.size FROM cls
JOIN man ON man.league = cls.league_name AND man.snapshot_id = cls.snap
WHERE man.phase = 'aborted'
  AND cls.category IN ('detail', 'agg', 'meta', 'raw', 'chunk', 'snapshot-state', 'worker-result')""")
def q_discard_aborted(spark, sf_dir):
    m = SO.aborted_checkpoints(AD.manifests(spark, sf_dir)) \
        .select("league", F.col("snapshotId").alias("snapshot_id"))
    plan = SO.discard_plan(_classified(spark, sf_dir), m)
    return plan.select("doc_id", "category", "size")


@register("manifest_flags", _INV_CTE + f"""
SELECT league, snapshot_id AS "snapshotId",
  phase IN ('ladder_capture', 'collecting', 'transforming') AS in_flight,
  phase IN ('collecting', 'transforming') AS live,
  epoch_ms(TIMESTAMPTZ '{NOW_STORAGE}') - epoch_ms(CAST(ladderCapturedAt AS TIMESTAMPTZ))
    > 48 * 3600000 AS aged,
  coalesce(epoch_ms(TIMESTAMPTZ '{NOW_STORAGE}') - epoch_ms(CAST(abortedAt AS TIMESTAMPTZ))
    < 72 * 3600000, false) AS cooling_down,
  (phase IN ('ladder_capture', 'collecting', 'transforming') AND schemaVersion <> 6) AS foreign_schema,
  phase = 'aborted' AS aborted
FROM man""")
def q_manifest_flags(spark, sf_dir):
    m = AD.manifests(spark, sf_dir)
    inflight = F.col("phase").isin("ladder_capture", "collecting", "transforming")
    foreign = SO.foreign_schema(m).select("league", "snapshotId").withColumn("__f", F.lit(True))
    out = m.join(foreign, ["league", "snapshotId"], "left").select(
        "league", "snapshotId", inflight.alias("in_flight"),
        F.col("phase").isin("collecting", "transforming").alias("live"),
        SO.aged(m, NOW_STORAGE, 48).alias("aged"),
        F.coalesce(SO.cooldown(NOW_STORAGE, 72), F.lit(False)).alias("cooling_down"),
        F.coalesce(F.col("__f"), F.lit(False)).alias("foreign_schema"),
        (F.col("phase") == "aborted").alias("aborted"))
    return out


@register("pick_league", _INV_CTE + """
SELECT coalesce((SELECT league FROM man WHERE phase IN ('ladder_capture', 'collecting', 'transforming')
                 ORDER BY (league = 'Standard') DESC, pos LIMIT 1), 'Standard') AS league""")
def q_pick_league(spark, sf_dir):
    return SO.pick_league(AD.manifests(spark, sf_dir), "Standard")


_TRIM_CTE = _INV_CTE + f""",
tot AS (SELECT CAST((SELECT sum(size) FROM cls) - coalesce((SELECT sum(size) FROM orph), 0) AS BIGINT)
               AS total),
det AS (SELECT league, snapshot_id, CAST(sum(size) AS BIGINT) AS bytes FROM cls
        WHERE category = 'detail' GROUP BY ALL),
aged AS (
  SELECT det.*, coalesce(CAST(epoch_ms(TRY_CAST(coalesce(meta.completedAt, meta.updatedAt)
                                                AS TIMESTAMPTZ)) AS DOUBLE), '-inf'::DOUBLE) AS age_ms
  FROM det LEFT JOIN meta ON det.league = meta.league AND det.snapshot_id = meta.snapshot_id
),
prot AS (
  SELECT *, row_number() OVER (PARTITION BY league ORDER BY age_ms DESC, snapshot_id)
            <= {KEEP_NEWEST} AS protected
  FROM aged
),
plan AS (
  SELECT league, snapshot_id, bytes, age_ms, protected,
    (SELECT total FROM tot) - coalesce(sum(bytes) OVER (ORDER BY age_ms, league, snapshot_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > (SELECT total FROM tot) / 2.0 AS trimmed
  FROM prot WHERE NOT protected
  UNION ALL
  SELECT league, snapshot_id, bytes, age_ms, protected, false FROM prot WHERE protected
)"""


@register("trim_plan", _TRIM_CTE + """
SELECT league, snapshot_id, bytes, age_ms, protected, trimmed FROM plan""")
def q_trim_plan(spark, sf_dir):
    plan = SO.retention_plan(_classified(spark, sf_dir), AD.manifests(spark, sf_dir),
                             AD.snapshot_meta(spark, sf_dir), KEEP_NEWEST, budget_fraction=0.5)
    return plan.select("league", "snapshot_id", "bytes", "age_ms", "protected", "trimmed")


# =====================================================================
# Request-log family
# =====================================================================
from quarry.operators import requests as RQ  # noqa: E402


def _windows_from_header(header: str, headroom: float = RQ.HEADROOM) -> list[tuple[int, int]]:
    """Pacing windows of a configured limit header (same rule as F14 +
    windows_of, evaluated on the configuration string)."""
    import math
    out = []
    for part in header.split(","):
        hits, period, _pen = (int(x) for x in part.strip().split(":"))
        if hits > 0 and period > 0:
            out.append((max(1, math.floor(hits * headroom)), period * 1000))
    return out


_CLASSIFY_SQL = r"""
WITH r AS (
  SELECT 'pages' AS source, page_id AS id,
    [200, 403, 404, 503, 400][page_id % 5 + 1] AS status,
    page_id % 7 = 0 AS flagged, html AS body FROM pages
  UNION ALL
  SELECT 'documents', doc_id, [200, 403, 404, 418][doc_id % 4 + 1], false, text FROM documents
  UNION ALL
  SELECT 'events', event_id,
    CASE event_type WHEN 'purchase' THEN 200 WHEN 'view' THEN 403 WHEN 'signup' THEN 404
      WHEN 'error' THEN 500 WHEN 'click' THEN 429 END,
    false, CASE WHEN event_type = 'error' THEN 'upstream failure' ELSE props END FROM events
),
h AS (
  SELECT *, json_valid(body) AS is_json,
    lower(substr(regexp_replace(body, '^\s+', ''), 1, 600)) AS h600,
    lower(substr(regexp_replace(body, '^\s+', ''), 1, 400)) AS h400
  FROM r
),
c AS (
  SELECT source, id, status,
    CASE WHEN status = 429 THEN 'rate_limited'
         WHEN status >= 500 THEN 'server_error'
         WHEN is_json THEN CASE WHEN status = 404 THEN 'dead' WHEN status = 403 THEN 'private'
                                WHEN status >= 400 THEN 'client_error' ELSE 'json' END
         WHEN flagged OR contains(h600, 'just a moment') OR contains(h600, '/cdn-cgi/challenge-platform')
              OR contains(h600, 'cf-challenge') OR contains(h600, '__cf_chl') THEN 'challenge'
         WHEN status = 404 THEN 'dead'
         WHEN status = 403 THEN 'private'
         WHEN starts_with(h400, '<') OR contains(h400, '<!doctype html') OR contains(h400, 'cloudflare')
              OR contains(h400, 'just a moment') THEN 'challenge'
         ELSE 'server_error' END AS category
  FROM h
)
SELECT source, id, status, category,
  CASE WHEN category = 'json' THEN 'ok' WHEN category IN ('private', 'dead', 'rate_limited')
       THEN category ELSE 'retryable' END AS kind,
  CASE WHEN category = 'rate_limited' THEN 'throttled' WHEN category = 'challenge' THEN 'challenge'
       WHEN category IN ('server_error', 'client_error') THEN 'error' ELSE 'ok' END AS signal
FROM c"""


@register("response_categories", _CLASSIFY_SQL)
def q_response_categories(spark, sf_dir):
    c = RQ.classify_response(AD.response_bodies(spark, sf_dir))
    return c.select("source", "id", "status", "category", RQ.result_kind().alias("kind"),
                    RQ.signal().alias("signal"))


_WINDOWS = _windows_from_header(AD.LIMIT_HEADER)


def _quota_oracle() -> str:
    parts = []
    for cap, period in _WINDOWS:
        parts.append(f"""
  SELECT ip, seq, {cap} AS cap, CAST({period} AS BIGINT) AS period_ms,
    count(*) OVER (PARTITION BY ip ORDER BY ts_ms RANGE BETWEEN {period - 1} PRECEDING
                   AND CURRENT ROW) AS hits,
    lag(ts_ms, {cap}) OVER (PARTITION BY ip ORDER BY ts_ms, seq) + {period} AS e, ts_ms
  FROM lg""")
    return ("WITH lg AS (SELECT CAST(user_id AS VARCHAR) AS ip, event_id AS seq, epoch_us(ts) // 1000 AS ts_ms "
            "FROM events), q AS (" + " UNION ALL ".join(parts) + """)
SELECT ip, seq, cap, period_ms, hits, coalesce(e > ts_ms, false) AS violation,
  CASE WHEN e > ts_ms THEN e END AS earliest_ms
FROM q""")


@register("quota_audit", _quota_oracle())
def q_quota_audit(spark, sf_dir):
    log = AD.request_log(spark, sf_dir).select("ip", "seq", "ts_ms", "headers")
    a = RQ.quota_audit(log, RQ.windows_of(RQ.rate_rules(F.col("headers"))))
    return a.select("ip", "seq", "cap", "period_ms", "hits", "violation", "earliest_ms")


@register("danger_streaks", """
WITH lg AS (
  SELECT CAST(user_id AS VARCHAR) AS ip, event_id AS seq, epoch_us(ts) // 1000 AS ts_ms,
    CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'throttled' ELSE 'ok' END AS sig,
    CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) * 1000 END AS retry_ms
  FROM events
),
isl AS (
  SELECT *,
    sum(CASE WHEN sig IN ('throttled', 'challenge') THEN 0 ELSE 1 END)
      OVER (PARTITION BY ip ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING) AS ti,
    sum(CASE WHEN sig = 'error' THEN 0 ELSE 1 END)
      OVER (PARTITION BY ip ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING) AS ei
  FROM lg
),
st AS (
  SELECT *,
    CAST(CASE WHEN sig IN ('throttled', 'challenge') THEN
      sum(CASE WHEN sig IN ('throttled', 'challenge') THEN 1 ELSE 0 END)
        OVER (PARTITION BY ip, ti ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING) ELSE 0 END AS BIGINT)
      AS throttle_streak,
    CAST(CASE WHEN sig = 'error' THEN
      sum(CASE WHEN sig = 'error' THEN 1 ELSE 0 END)
        OVER (PARTITION BY ip, ei ORDER BY ts_ms, seq ROWS UNBOUNDED PRECEDING) ELSE 0 END AS BIGINT)
      AS error_streak
  FROM isl
)
SELECT ip, seq, sig AS signal, throttle_streak, error_streak,
  CASE WHEN sig IN ('throttled', 'challenge')
         THEN CAST(least(300000.0, coalesce(CAST(retry_ms AS DOUBLE), 5000 * pow(2, throttle_streak - 1))) AS BIGINT)
       WHEN sig = 'error'
         THEN CAST(least(300000.0, coalesce(CAST(retry_ms AS DOUBLE), 2000 * pow(2, error_streak - 1))) AS BIGINT)
  END AS backoff_ms,
  throttle_streak >= 3 OR error_streak >= 8 AS abort
FROM st""")
def q_danger_streaks(spark, sf_dir):
    log = RQ.classify_response(AD.request_log(spark, sf_dir))
    log = log.select("ip", "seq", "ts_ms", RQ.signal().alias("signal"),
                     RQ.retry_after_ms(F.col("headers"), F.col("ts")).alias("retry_ms"))
    s = RQ.danger_streaks(log)
    return s.select("ip", "seq", "signal", "throttle_streak", "error_streak", "backoff_ms", "abort")


@register("rate_rule_summary", f"""
WITH st AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
)
SELECT 'Ip' AS rule, t.hits, t.period_sec, t.penalty_sec, (SELECT count(*) FROM events) AS responses,
  (SELECT CAST(coalesce(max(CASE WHEN k % 5 > 0 AND k % 3 = 0 THEN 60 ELSE 0 END), 0) AS INTEGER)
   FROM st) AS max_restriction_sec
FROM (VALUES (2, 3600, 60), (5, 86400, 600)) AS t(hits, period_sec, penalty_sec)""")
def q_rate_rule_summary(spark, sf_dir):
    return RQ.rate_rule_summary(AD.request_log(spark, sf_dir))


# =====================================================================
# Economy (P15, U4, J8, A16, V4) and quality gates
# =====================================================================
from quarry.operators import economy as EC  # noqa: E402
from quarry.operators import normalize as NZ  # noqa: E402
from quarry.operators import quality as QA  # noqa: E402

NOW_ECONOMY = "2024-01-20T00:00:00.000Z"

_LEAGUES_CTE = f"""
WITH lr AS (
  SELECT n_name AS id,
    CASE WHEN n_regionkey = 0 THEN 'Standard' ELSE 'cat' || n_regionkey END AS category_id,
    CASE WHEN n_nationkey % 6 = 5 THEN NULL WHEN n_nationkey % 6 = 4 THEN 'soon'
         ELSE '2024-01-' || lpad(CAST(n_nationkey % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' END
      AS start_at,
    CASE WHEN n_nationkey % 4 = 0 THEN NULL WHEN n_nationkey % 4 = 3 THEN 'garbage'
         ELSE '2024-02-' || lpad(CAST((n_nationkey + 3) % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' END
      AS end_at,
    n_nationkey AS pos
  FROM nation
),
kept AS (
  SELECT id, min(pos) AS pos FROM lr
  WHERE coalesce(category_id, '') <> 'Standard' AND start_at IS NOT NULL
    AND NOT coalesce(TRY_CAST(start_at AS TIMESTAMPTZ) > TIMESTAMPTZ '{NOW_ECONOMY}', false)
    AND NOT (end_at IS NOT NULL
             AND coalesce(TRY_CAST(end_at AS TIMESTAMPTZ) <= TIMESTAMPTZ '{NOW_ECONOMY}', false))
  GROUP BY id
),
act AS (
  SELECT id, row_number() OVER (ORDER BY pos NULLS LAST, id) - 1 AS position FROM (
    SELECT id, pos FROM kept
    UNION ALL SELECT 'Standard', NULL WHERE NOT EXISTS (SELECT 1 FROM kept WHERE id = 'Standard'))
)"""


@register("active_leagues", _LEAGUES_CTE + "\nSELECT id, position FROM act")
def q_active_leagues(spark, sf_dir):
    return EC.active_leagues(AD.league_rows(spark, sf_dir), NOW_ECONOMY)


_PAIRS_VALUES = ", ".join(f"({i}, '{ep}', '{t}')" for i, (ep, t) in enumerate(EC.CATALOGUE_PAIRS))
_ECON_CTE = _LEAGUES_CTE + f""",
cat AS (SELECT * FROM (VALUES {_PAIRS_VALUES}) AS v(pair_pos, endpoint, type)),
resp AS (
  SELECT n.n_name AS league, cat.endpoint, cat.type,
    CASE WHEN e.event_type = 'error' THEN 500 WHEN e.event_type = 'click' THEN 429 ELSE 200 END
      AS status, e.ts, e.event_id AS seq
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN cat ON cat.pair_pos = e.event_id % {len(EC.CATALOGUE_PAIRS)}
),
seen AS (
  SELECT league, endpoint, type, bool_or(status = 200) AS fetched,
    arg_max(status, (ts, seq)) AS last_status
  FROM resp GROUP BY ALL
),
comp AS (
  SELECT act.id AS league, cat.pair_pos, cat.endpoint, cat.type,
    coalesce(seen.fetched, false) AS fetched,
    CASE WHEN coalesce(seen.fetched, false) THEN NULL
         WHEN seen.last_status IS NULL THEN 'not fetched'
         WHEN seen.last_status = 429 THEN 'throttled (429)'
         WHEN seen.last_status >= 500 THEN 'server error (' || seen.last_status || ')'
         ELSE 'unexpected status ' || seen.last_status END AS reason
  FROM act CROSS JOIN cat
  LEFT JOIN seen ON seen.league = act.id AND seen.endpoint = cat.endpoint AND seen.type = cat.type
)"""


def _completeness(spark, sf_dir):
    leagues = EC.active_leagues(AD.league_rows(spark, sf_dir), NOW_ECONOMY)
    return EC.economy_completeness(leagues, AD.economy_responses(spark, sf_dir))


@register("economy_completeness", _ECON_CTE + """
SELECT league, pair_pos, endpoint, type, fetched, reason FROM comp""")
def q_economy_completeness(spark, sf_dir):
    return _completeness(spark, sf_dir)


@register("economy_report", _ECON_CTE + """
SELECT league, count(*) FILTER (WHERE fetched) AS categories_fetched,
  coalesce(string_agg(pair_pos || ':' || endpoint || '/' || type || '=' || reason, ';'
                      ORDER BY pair_pos) FILTER (WHERE NOT fetched), '') AS failures,
  count(*) FILTER (WHERE NOT fetched) = 0 AS written
FROM comp GROUP BY league""")
def q_economy_report(spark, sf_dir):
    rep = EC.economy_league_report(_completeness(spark, sf_dir))
    text = F.array_join(F.transform("failures", lambda f: F.concat(
        f["pair_pos"].cast("string"), F.lit(":"), f["endpoint"], F.lit("/"), f["type"], F.lit("="),
        f["reason"])), ";")
    return rep.select("league", "categories_fetched", text.alias("failures"), "written")


@register("tree_coverage", _PASSIVES_CTE + """
, tc AS (
  SELECT ta.character_key, ta.node_hash, p.p_partkey IS NOT NULL AS resolved
  FROM ta LEFT JOIN part p ON p.p_partkey = ta.node_hash
)
SELECT h.distinct_allocated, h.distinct_resolved, c.characters_with_passives,
  c.fully_resolved_characters,
  CASE WHEN h.distinct_allocated = 0 THEN 0.0
       ELSE h.distinct_resolved / h.distinct_allocated END AS resolve_rate,
  (CASE WHEN h.distinct_allocated = 0 THEN 0.0 ELSE h.distinct_resolved / h.distinct_allocated END) >= 0.9
    AND c.characters_with_passives > 0 AS passes
FROM (SELECT count(*) AS distinct_allocated, count(*) FILTER (WHERE r) AS distinct_resolved
      FROM (SELECT node_hash, bool_or(resolved) AS r FROM tc GROUP BY node_hash)) h,
     (SELECT count(*) AS characters_with_passives, count(*) FILTER (WHERE f) AS fully_resolved_characters
      FROM (SELECT character_key, bool_and(resolved) AS f FROM tc GROUP BY character_key)) c""")
def q_tree_coverage(spark, sf_dir):
    s = _snap(spark, sf_dir)
    return QA.tree_gate(AG.coverage_rate(NZ.tree_allocations(s.chars), s.tree))


@register("unresolved_topk", _PASSIVES_CTE + """
SELECT node_hash, count(*) AS occurrences FROM ta
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = ta.node_hash)
GROUP BY node_hash ORDER BY occurrences DESC, node_hash LIMIT 20""")
def q_unresolved_topk(spark, sf_dir):
    s = _snap(spark, sf_dir)
    return AG.unresolved_topk(NZ.tree_allocations(s.chars), s.tree, 20)


def _gate_metrics(spark, sf_dir):
    """Gate inputs of the identity state under two manifests: what the tables
    hold, and one character more."""
    s = _snap(spark, sf_dir)
    tally = AG.coverage(AG.tally_outcomes(snapshot.identity_state(spark, sf_dir)))
    cls = AG.class_distribution(s.table("characters")).agg(
        F.count(F.lit(1)).alias("class_rows"), F.coalesce(F.sum("count"), F.lit(0)).alias("class_total"))
    rows = s.chars.agg(F.count(F.lit(1)).alias("character_rows"))
    claims = snapshot.claimed_total(spark, sf_dir).withColumn("claim", F.explode(F.array(F.lit("as counted"), F.lit("one more")))) \
        .withColumn("total_characters", F.col("total_characters") + (F.col("claim") == "one more").cast("long"))
    m = tally.drop("total").crossJoin(rows).crossJoin(cls).crossJoin(claims)  # one-row and two-row tables
    return m.select(
        "claim", F.lit(6).alias("schema_version"), F.lit(NOW_1).alias("ladder_captured_at"),
        (F.col("pending_of") == 0).alias("complete"),
        F.when(F.col("pending_of") == 0, F.lit(NOW_2)).alias("completed_at"),
        F.col("pending_of").alias("pending"), F.col("skipped"),
        F.col("pending_of").alias("meta_pending"), F.col("skipped").alias("meta_skipped"),
        "ok", "private", "dead", "total_characters",
        "character_rows", F.col("character_rows").alias("meta_character_count"),
        "class_rows", "class_total",
        F.array(*[F.struct(F.lit(k).alias("kind"), F.col("character_rows").alias("total"))
                  for k in ("class_distribution", "skill_popularity", "unique_usage",
                            "keystone_usage")]).alias("agg_totals"))


_IDENTITY_CTE = """,
ident AS (
  SELECT c_name, o_orderpriority, bool_or(o_orderstatus = 'F') AS is_ok, arg_max(o_orderstatus, o_orderkey) AS last
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
),
t AS (
  SELECT count(*) FILTER (WHERE is_ok) AS ok, count(*) FILTER (WHERE NOT is_ok AND last = 'O') AS pending,
    count(*) FILTER (WHERE NOT is_ok AND last = 'P') AS private, count(*) AS total FROM ident
)"""


@register("snapshot_gate", _SNAP_CTE + _IDENTITY_CTE + """,
m AS (SELECT claim, pending, ok, private, total + extra AS total, (SELECT count(*) FROM ch) AS rows
      FROM t, (VALUES ('as counted', 0), ('one more', 1)) AS c(claim, extra))
SELECT claim, pending = 0 AS complete, ok, rows AS character_rows,
  array_to_string(list_filter([
    CASE WHEN ok + private + pending <> total THEN 'coverage ' || (ok + private) || ' + pending ' || pending
      || ' + skipped 0 differs from total ' || total END,
    CASE WHEN rows <> ok THEN 'characters rows ' || rows || ' differ from ok coverage ' || ok END,
    CASE WHEN ok <= 0 THEN 'zero collected characters' END], lambda x: x IS NOT NULL), '; ') AS errors,
  ok + private + pending = total AND rows = ok AND ok > 0 AS ok_to_publish
FROM m""")
def q_snapshot_gate(spark, sf_dir):
    v = QA.validate_snapshot(_gate_metrics(spark, sf_dir))
    return v.select("claim", "complete", "ok", "character_rows", F.array_join("errors", "; ").alias("errors"),
                    "ok_to_publish")


# =====================================================================
# Streaming (R1, R3, R4, R5): file streams staged under the shared
# checkpoint folder, run with availableNow, read back as tables.
# =====================================================================
from quarry.session import checkpoint_root  # noqa: E402
from quarry.streaming import incremental as SM  # noqa: E402


@register("stream_merge_results", _STATE_CTE + """
SELECT ordinal, account, "character", outcome, attempts, fetchedAt FROM merged""")
def q_stream_merge_results(spark, sf_dir):
    """R1 + R3: result files streamed one per batch, the source replayed once
    from the start (its checkpoint lost), full state columns."""
    root = checkpoint_root(spark, "stream-merge", unique=True)
    results = AD.event_results(spark, sf_dir)
    src = SM.stage_files(results, f"{root}/results", 4, ["seq"])
    seed = _seeded(spark, sf_dir)
    schema = spark.read.parquet(src).schema
    each = SM.files_a_batch(spark, src, 4)
    SM.incremental_merge(spark, seed, src, schema, f"{root}/first", files_per_trigger=each)
    final = SM.incremental_merge(spark, seed, src, schema, f"{root}/again", files_per_trigger=2 * each)
    return final.select("ordinal", "account", "character", "outcome", "attempts", "fetchedAt")


@register("stream_latest_event", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_stream_latest_event(spark, sf_dir):
    """Latest event per user, as keyed streaming state."""
    root = checkpoint_root(spark, "stream-latest", unique=True)
    ev = AD.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    src = SM.stage_files(ev, f"{root}/events", 4, ["ts", "event_id"])
    table = SM.latest_state(spark, src, spark.read.parquet(src).schema, root,
                            ["user_id"], ["ts", "event_id"], files_per_trigger=SM.files_a_batch(spark, src, 4))
    return SM.read_latest(spark, table, ["user_id"]).select("user_id", "event_id", "event_type", "value")


@register("stream_hourly_quota", """
SELECT CAST(user_id AS VARCHAR) AS ip,
  epoch_ms(time_bucket(INTERVAL 1 hour, ts)) AS window_start_ms,
  count(*) AS hits
FROM events GROUP BY ALL""")
def q_stream_hourly_quota(spark, sf_dir):
    """Hits per ip per hour with a watermark for late log lines."""
    root = checkpoint_root(spark, "stream-quota", unique=True)
    log = AD.request_log(spark, sf_dir).select("ip", "ts", "seq")
    src = SM.stage_files(log, f"{root}/log", 4, ["ts", "seq"])
    # Files arrive in any order, so a line may be as late as the log is long.
    table, late = SM.streaming_quota(spark, src, spark.read.parquet(src).schema, root,
                                     "ip", "ts", "1 hour", "3650 days", files_per_trigger=SM.files_a_batch(spark, src, 4))
    if late:
        raise RuntimeError(f"{late} lines were too late to be counted")
    latest = SM.read_latest(spark, table, ["ip", "window_start"])
    # epoch milliseconds: no session time zone is involved in the output
    return latest.select("ip", F.unix_millis("window_start").alias("window_start_ms"), "hits")


# =====================================================================
# Ladder capture (S11, S12) feeding the roster merge
# =====================================================================
_LADDER_CTE = f"""
WITH j AS (
  SELECT o.*, c.c_name, c.c_mktsegment, r.r_regionkey, r.r_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
tot AS (SELECT r_regionkey, count(*) AS total FROM j GROUP BY r_regionkey),
top AS (
  SELECT *, row_number() OVER (PARTITION BY r_regionkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
  FROM j QUALIFY rk <= {AD.LADDER_DEPTH}
),
ent AS (
  SELECT r_name AS capture, r_regionkey, ((rk - 1) // {AD.LADDER_PAGE}) * {AD.LADDER_PAGE} AS "offset",
    CAST(rk AS INTEGER) AS rank,
    CASE WHEN o_orderkey % 53 <> 0 AND o_orderkey % 59 <> 0 THEN c_name END AS account, 'c' || o_orderkey AS "character",
    coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN c_mktsegment END, 'Unknown') AS class,
    coalesce(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 100 AS INTEGER) END, 0) AS level,
    (rk - 1) % {AD.LADDER_PAGE} AS rawpos
  FROM top
),
exp AS (
  SELECT r.r_regionkey, r.r_name AS capture, e.off
  FROM region r CROSS JOIN (SELECT unnest(range(0, {AD.LADDER_DEPTH}, {AD.LADDER_PAGE})) AS off) e
),
st AS (
  SELECT exp.capture, exp.off,
    CASE WHEN (exp.r_regionkey = 4 AND exp.off = 400) THEN 0
         ELSE (SELECT count(*) FROM ent WHERE ent.r_regionkey = exp.r_regionkey
               AND ent."offset" = exp.off AND ent.account IS NOT NULL) END AS n,
    coalesce(tot.total, 0) AS total,
    (exp.r_regionkey = 3 AND exp.off = 200) OR (exp.r_regionkey = 4 AND exp.off = 400) AS bad
  FROM exp LEFT JOIN tot ON tot.r_regionkey = exp.r_regionkey
),
cum AS (SELECT *, sum(n) OVER (PARTITION BY capture ORDER BY off ROWS UNBOUNDED PRECEDING) AS c FROM st),
stops AS (SELECT capture, min(off) FILTER (WHERE n = 0 OR c >= total) AS stop FROM cum GROUP BY capture),
void AS (
  SELECT cum.capture, max(CAST(bad AS INTEGER)) AS v FROM cum JOIN stops USING (capture)
  WHERE stops.stop IS NULL OR cum.off <= stops.stop GROUP BY cum.capture
)"""


@register("ladder_capture", _LADDER_CTE + """
SELECT ent.capture, ent."offset", rank, account, "character", class, level
FROM ent JOIN stops USING (capture) JOIN void USING (capture)
WHERE void.v = 0 AND ent.account IS NOT NULL AND (stops.stop IS NULL OR ent."offset" <= stops.stop)""")
def q_ladder_capture(spark, sf_dir):
    e = RO.ladder_window(AD.ladder_pages(spark, sf_dir), AD.LADDER_DEPTH, AD.LADDER_PAGE, by=["capture"])
    return e.select("capture", "offset", "rank", "account", "character", "class", "level")


# =====================================================================
# Catalogue (J10, O4, S22 rows), mod attribution (J7), stale pace (P14),
# unmapped leagues (V6), rolled-up tallies (A2), run report
# =====================================================================
@register("catalogue_refresh", _TRIM_CTE + """,
cat0 AS (
  SELECT league, snapshot_id, ladderCapturedAt, schemaVersion, true AS hasDetail, false AS is_new
  FROM man WHERE phase = 'published'
),
newrows AS (
  SELECT league, snapshot_id, ladderCapturedAt, 6 AS schemaVersion, true AS hasDetail, true AS is_new
  FROM man WHERE phase = 'transforming'
),
up AS (
  SELECT * FROM cat0 WHERE NOT EXISTS (
    SELECT 1 FROM newrows n WHERE n.league = cat0.league AND n.snapshot_id = cat0.snapshot_id)
  UNION ALL SELECT * FROM newrows
),
marked AS (
  SELECT up.league, up.snapshot_id, up.ladderCapturedAt, up.schemaVersion, up.is_new,
    CASE WHEN t.league IS NOT NULL THEN false ELSE up.hasDetail END AS hasDetail
  FROM up LEFT JOIN (SELECT DISTINCT league, snapshot_id FROM plan WHERE trimmed) t
    ON t.league = up.league AND t.snapshot_id = up.snapshot_id
)
SELECT league, snapshot_id, ladderCapturedAt, schemaVersion, hasDetail,
  row_number() OVER (ORDER BY ladderCapturedAt DESC, league, is_new DESC, snapshot_id) - 1 AS position
FROM marked""")
def q_catalogue_refresh(spark, sf_dir):
    m = AD.manifests(spark, sf_dir).withColumnRenamed("snapshotId", "snapshot_id")
    cat0 = (m.where(F.col("phase") == "published")
            .select("league", "snapshot_id", "ladderCapturedAt", "schemaVersion",
                    F.lit(True).alias("hasDetail"), F.lit(False).alias("is_new")))
    new = (m.where(F.col("phase") == "transforming")
           .select("league", "snapshot_id", "ladderCapturedAt", F.lit(6).alias("schemaVersion"),
                   F.lit(True).alias("hasDetail"), F.lit(True).alias("is_new")))
    trimmed = q_trim_plan(spark, sf_dir).where("trimmed")
    cat = SO.mark_trimmed(SO.catalogue_upsert(cat0, new), trimmed)
    return SO.order_catalogue(cat).select("league", "snapshot_id", "ladderCapturedAt", "schemaVersion",
                                          "hasDetail", "position")


_ITEMS_MODS_CTE = _SNAP_CTE + """,
im AS (
  SELECT character_key || '#' || k AS item_key, 'implicit' AS mod_domain FROM li WHERE l_linenumber % 2 = 1
  UNION ALL SELECT character_key || '#' || k, 'explicit' FROM li
  UNION ALL SELECT character_key || '#' || k, 'explicit' FROM li
  UNION ALL SELECT character_key || '#' || k, 'crafted' FROM li WHERE l_returnflag = 'R'
  UNION ALL SELECT character_key || '#' || k, 'enchant' FROM li WHERE p_size > 45
  UNION ALL SELECT character_key || '#' || k, 'fractured' FROM li WHERE l_linenumber = 1
  UNION ALL SELECT character_key || '#' || k, 'veiled' FROM li WHERE l_suppkey % 10 = 3
  UNION ALL SELECT character_key || '#' || k, 'utility' FROM li WHERE slot = 'Flask'
  UNION ALL SELECT character_key || '#p' || j, 'explicit' FROM jw
),
it AS (
  SELECT character_key || '#' || k AS item_id, slot,
    CASE p_size % 4 WHEN 0 THEN 'Unique' WHEN 1 THEN 'Rare' WHEN 2 THEN 'Magic' ELSE 'Normal' END AS rarity
  FROM li WHERE slot IS NOT NULL
  UNION ALL SELECT character_key || '#p' || j, 'PassiveJewels', 'Magic' FROM jw
)"""


@register("mod_attribution", _ITEMS_MODS_CTE + """
SELECT it.slot, it.rarity, im.mod_domain, count(*) AS mods, count(DISTINCT it.item_id) AS items
FROM im JOIN it ON im.item_key = it.item_id GROUP BY ALL""")
def q_mod_attribution(spark, sf_dir):
    s = _snap(spark, sf_dir)
    j = NZ.attributed_mods(s.items_with(NZ.ATTRIBUTED_FIELDS))
    return j.groupBy("slot", "rarity", "mod_domain").agg(
        F.count(F.lit(1)).alias("mods"), F.count_distinct("item_key").alias("items"))


PACE_TTL_MS = 3 * 24 * 3600 * 1000


@register("stale_pace", _INV_CTE + f"""
SELECT doc_id, stale FROM (
  SELECT doc_id, NOT (doc_id % 9 <> 0) OR coalesce(
    epoch_ms(TIMESTAMPTZ '{NOW_STORAGE}') - epoch_ms(TRY_CAST(
      CASE WHEN doc_id % 4 = 0 THEN 'garbage'
           ELSE '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00.000Z' END
      AS TIMESTAMPTZ)) > {PACE_TTL_MS}, false) AS stale
  FROM cls WHERE category = 'ip')""")
def q_stale_pace(spark, sf_dir):
    ips = _classified(spark, sf_dir).where(F.col("category") == "ip")
    i = F.col("doc_id")
    entries = ips.select("doc_id", (i % 9 != 0).alias("readable"),
                         F.when(i % 4 == 0, F.lit("garbage")).otherwise(F.concat(
                             F.lit("2024-01-"), F.lpad((i % 28 + 1).cast("string"), 2, "0"),
                             F.lit("T00:00:00.000Z"))).alias("updatedAt"))
    return SO.stale_pace(entries, NOW_STORAGE, PACE_TTL_MS).select("doc_id", "stale")


@register("unmapped_leagues", _LEAGUES_CTE + """
SELECT id FROM act WHERE id <> 'Standard'
  AND id NOT IN (SELECT n_name FROM nation WHERE n_regionkey <= 2)""")
def q_unmapped_leagues(spark, sf_dir):
    active = EC.active_leagues(AD.league_rows(spark, sf_dir), NOW_ECONOMY)
    n = AD.table(spark, sf_dir, "nation")
    versions = (n.where(F.col("n_regionkey") <= 2)
                .select(F.col("n_name").alias("league"),
                        F.concat(F.lit("3."), F.col("n_regionkey").cast("string")).alias("version"))
                .unionByName(spark.range(1).select(F.lit(EC.PERMANENT_LEAGUE).alias("league"),
                                                   F.lit("3.0").alias("version"))))
    return QA.unmapped_leagues(active, versions).select("id")


@register("rolled_tally", _STATE_CTE + """
SELECT count(*) FILTER (WHERE outcome = 'pending') AS pending,
  count(*) FILTER (WHERE outcome = 'ok') AS ok,
  count(*) FILTER (WHERE outcome = 'private') AS private,
  count(*) FILTER (WHERE outcome = 'retryable') AS retryable,
  count(*) FILTER (WHERE outcome = 'dead') AS dead,
  count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
  count(DISTINCT ordinal % 15) AS slots
FROM merged""")
def q_rolled_tally(spark, sf_dir):
    """A2: per-worker-slot tallies (A1 per slot) rolled into one."""
    slotted = ST.assign(_merged(spark, sf_dir), WORKERS)
    per_slot = slotted.groupBy("slot").agg(
        *[F.count_if(F.col("outcome") == k).alias(k) for k in ("pending", "ok", "private", "retryable",
                                                              "dead", "skipped")])
    rolled = AG.add_tallies(per_slot)
    return rolled.crossJoin(per_slot.agg(F.count(F.lit(1)).alias("slots")))


@register("run_report", _ROSTER_CTE + """
SELECT (SELECT count(*) FROM r2 WHERE is_new) AS added,
  (SELECT count(*) FROM ent WHERE NOT first) - (SELECT count(*) FROM r2 WHERE is_new) AS refreshed,
  (SELECT count(*) FROM r2) AS roster_size""")
def q_run_report(spark, sf_dir):
    """Run counters gathered with ``observe()`` on the job that writes
    the roster (no extra pass), returned as a one-row table."""
    roster, counts = _rosters(spark, sf_dir)
    out = checkpoint_root(spark, "run-report", unique=True)
    report = SO.observed_write(roster, out, "roster")
    return counts.crossJoin(spark.createDataFrame([(report["rows"],)], "roster_size long"))


# Lifecycle queries (publish, catalogue, documents, orders) register themselves.
from quarry.plans import lifecycle  # noqa: E402,F401
