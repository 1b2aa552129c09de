"""op12: conversations are damaged by a rule and repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import repair, store


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows after damage; nulls in role and text are one space."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20
    text = F.when(F.col("d_") == 1, "").when(F.col("d_") == 2, F.regexp_replace(some("text"), "[.!?]", "")).otherwise(some("text"))
    out = rows.select("conv_id", "turn", "role", "text", kind.alias("d_")).where("d_ <> 0")
    out = out.select("conv_id", "turn", F.when(F.col("d_") == 4, "user").otherwise(some("role")).alias("role"), text.alias("text"), "d_")
    return out.withColumn("copy_", F.explode(F.when(F.col("d_") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("d_", "copy_")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    with store.scratch(spark) as own:
        facts = repair.facts(damaged(rows), "conv_id", "turn", "role", "text")
        found = repair.report(facts, store.cut(repair.edits(facts), "edits")).drop("key").withColumnRenamed("conv", "c_")
        every = rows.select("conv_id").distinct()
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
        out = every.join(found, F.col("conv_id").eqNullSafe(F.col("c_")), "left").select(
            "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")
        )
        return own.keep(out, "repaired")


_INK = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
#: CRC-32 of a text.
_CRC = "xor(list_reduce(list_transform(range(1, length({x}) + 1), lambda i: ascii(({x})[i])::BIGINT), lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda y, k: xor(y >> 1, 3988292384 * (y & 1)), xor(c, b)), 4294967295::BIGINT), 4294967295)"
_FAR = "999999999"


def _state(s: int, ways: str, to: int) -> str:
    """The least cost of a row in a state, before insertions: x is the fault, c the letter, e the costs behind the row."""
    return f"least(3 + e{s}, CASE WHEN x IN ('blank', 'duplicate') THEN {_FAR} ELSE (x = 'truncated')::BIGINT + least(2 + e{to}, CASE {ways} ELSE {_FAR} END) END)"


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLE = {
    "op12_conversation_repair": f"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format(x="(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS d FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) AS copy FROM o WHERE d <> 0),
n AS (SELECT *, coalesce('1' || conv_id::VARCHAR, '0') AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || text), copy) AS i FROM d),
m AS (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY i) AS again FROM n),
r AS (SELECT *, substr(role, 1, 1) AS c, CASE WHEN {_INK} = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
    WHEN right({_INK}, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS x FROM m),
z AS (SELECT k, max(i) AS n FROM r GROUP BY k),
b(k, i, e0, e1, e2, e3) AS (SELECT k, n + 1, 0::BIGINT, 4::BIGINT, 2::BIGINT, 0::BIGINT FROM z UNION ALL
  SELECT k, i, least(x0, 2 + x2, 4 + x3), least(x1, 2 + x2, 4 + x3), least(x2, 2 + x3), least(x3, 2 + x2) FROM (
    SELECT r.k, r.i, {_state(0, "WHEN c = 's' THEN e1 WHEN c = 'u' THEN e2", 2)} AS x0, {_state(1, "WHEN c = 'u' THEN e2", 2)} AS x1,
      {_state(2, "WHEN c = 'a' THEN e3", 3)} AS x2, {_state(3, "WHEN c = 'u' THEN e2", 2)} AS x3
    FROM b JOIN r ON r.k = b.k AND r.i = b.i - 1)),
c AS (SELECT k, i, [e0, e1, e2, e3] AS e FROM b),
f(k, i, s, audit, kept) AS (SELECT k, 1::BIGINT, 0, '', []::VARCHAR[] FROM z UNION ALL
  SELECT k, CASE WHEN a = 'I' THEN i ELSE i + 1 END,
    CASE a WHEN 'D' THEN s WHEN 'K' THEN CASE l WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE WHEN s = 2 THEN 3 ELSE 2 END END, audit || a,
    CASE a WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, role || ':' || text)
      ELSE list_append(kept, CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END || CASE WHEN a = 'R' THEN text ELSE '' END) END
  FROM (SELECT f.*, role, text, r.c AS l, CASE
      WHEN r.k IS NULL THEN CASE WHEN s IN (1, 2) THEN 'I' END
      WHEN c.e[s + 1] = 3 + y.e[s + 1] THEN 'D'
      WHEN c.e[s + 1] = 2 + c.e[CASE WHEN s = 2 THEN 4 ELSE 3 END] THEN 'I'
      WHEN x NOT IN ('blank', 'duplicate') AND c.e[s + 1] = (x = 'truncated')::BIGINT + CASE WHEN r.c = 's' AND s = 0 THEN y.e[2] WHEN r.c = 'u' AND s <> 2 THEN y.e[3] WHEN r.c = 'a' AND s = 2 THEN y.e[4] ELSE {_FAR} END THEN 'K'
      ELSE 'R' END AS a
    FROM f JOIN c ON c.k = f.k AND c.i = f.i LEFT JOIN r ON r.k = f.k AND r.i = f.i LEFT JOIN c y ON y.k = f.k AND y.i = f.i + 1) WHERE a IS NOT NULL),
t AS (SELECT k, max_by(audit, length(audit)) AS audit, max_by(kept, length(audit)) AS kept FROM f GROUP BY k),
l AS (SELECT *, lag(c) OVER (PARTITION BY k ORDER BY i) AS p FROM r),
g AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (x = 'blank') AS blank, count(*) FILTER (x = 'duplicate') AS duplicate,
    count(*) FILTER (x = 'truncated') AS truncated, count(*) FILTER (p || c NOT IN ('su', 'ua', 'au')) AS illegal FROM l GROUP BY k),
v AS (SELECT DISTINCT conv_id, coalesce('1' || conv_id::VARCHAR, '0') AS k FROM conversations)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(c.e[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS repaired_sha256
FROM v LEFT JOIN g ON g.k = v.k LEFT JOIN c ON c.k = v.k AND c.i = 1 LEFT JOIN t ON t.k = v.k"""
}
