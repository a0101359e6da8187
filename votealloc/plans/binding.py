"""The driver's star schema seen as elections: counties, precincts, contests, blocks and districts.

Each table is given twice, as a DataFrame and as a common table expression for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCOPES = {"congressional": 14, "state_house": 12, "state_senate": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Result rows: one party's candidate in a precinct of a county, contest and year.
RES = """res AS (
  SELECT CAST(year(o_orderdate) AS INT) AS year, upper(n_name) AS county,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'ABSENTEE' ELSE c_mktsegment END AS precinct, o_orderpriority AS office,
         CASE o_orderstatus WHEN 'F' THEN 'DEM' WHEN 'O' THEN 'REP' ELSE 'LIB' END AS party,
         concat(CASE o_orderstatus WHEN 'F' THEN 'Dem' WHEN 'O' THEN 'Rep' ELSE 'Lib' END, CASE WHEN o_orderkey % 3 = 0 THEN ' Ash' ELSE ' Birch' END) AS candidate,
         CAST(count(*) AS DOUBLE) AS votes
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4, 5, 6)"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.upper("n_name").alias("county"))
    place = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.when(F.col("o_orderstatus") == "F", "Dem").when(F.col("o_orderstatus") == "O", "Rep").otherwise("Lib")
    rows = orders.join(place, F.col("o_custkey") == F.col("c_custkey")).select(
        "year", "county", F.when(F.col("c_mktsegment") == "FURNITURE", "ABSENTEE").otherwise(F.col("c_mktsegment")).alias("precinct"),
        F.col("o_orderpriority").alias("office"), F.upper(name).alias("party"),
        F.concat(name, F.when(F.col("o_orderkey") % 3 == 0, " Ash").otherwise(" Birch")).alias("candidate"),
    )
    return rows.groupBy("year", "county", "precinct", "office", "party", "candidate").agg(F.count("*").cast("double").alias("votes"))


#: Blocks with their precinct and voting-age population; one precinct is missing from the map.
BLK = """blk AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS block, upper(n_name) AS county, concat(upper(n_name), ' - ', c_mktsegment) AS precinct_id,
         CAST(floor(greatest(c_acctbal, 0)) AS BIGINT) AS vap, c_custkey AS k
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT (n_nationkey = 3 AND c_mktsegment = 'BUILDING'))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).where(~((F.col("n_nationkey") == 3) & (F.col("c_mktsegment") == "BUILDING")))
    return rows.select(
        F.lpad(F.col("c_custkey").cast("string"), 15, "0").alias("block"), F.upper("n_name").alias("county"), F.concat(F.upper("n_name"), F.lit(" - "), "c_mktsegment").alias("precinct_id"),
        F.floor(F.greatest("c_acctbal", F.lit(0.0))).cast("long").alias("vap"), F.col("c_custkey").alias("k"),
    )


#: The district of each block in each scope.
DMAP = """dmap AS (
  SELECT block, scope, CAST(k % n + 1 AS VARCHAR) AS district FROM blk
  CROSS JOIN (VALUES ('congressional', 14), ('state_house', 12), ('state_senate', 5)) AS s(scope, n))"""


def district_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    scopes = F.explode(F.array(*[F.struct(F.lit(scope).alias("scope"), F.lit(n).alias("n")) for scope, n in SCOPES.items()])).alias("s")
    return blocks(spark, sf_dir).select("block", "k", scopes).select("block", "s.scope", (F.col("k") % F.col("s.n") + 1).cast("string").alias("district"))


#: Messy precinct labels derived from customers. The text is valid in both dialects.
_LABEL = """CASE c_custkey % 16
  WHEN 0 THEN concat(lpad(CAST(c_custkey % 40 AS {text}), 2, '0'), '-', lpad(CAST(c_custkey % 17 AS {text}), 3, '0'), 'A')
  WHEN 1 THEN concat(' precinct ', CAST(c_custkey % 90 AS {text}), ' ')
  WHEN 2 THEN concat('PCT ', lpad(CAST(c_custkey % 200 AS {text}), 3, '0'), '.1')
  WHEN 3 THEN concat('0', CAST(c_custkey % 9 AS {text}), '_', c_mktsegment)
  WHEN 4 THEN concat('os ', c_mktsegment)
  WHEN 5 THEN concat(c_mktsegment, ' One Stop')
  WHEN 6 THEN 'PROVIDENCE'
  WHEN 7 THEN CAST(c_custkey % 5000 AS {text})
  WHEN 8 THEN concat(CAST(c_custkey % 30 AS {text}), '.', CAST(c_custkey % 7 AS {text}))
  WHEN 9 THEN concat('VTD ', CAST(c_custkey % 30 AS {text}), 'N  ', c_mktsegment)
  WHEN 10 THEN concat('EV-', c_mktsegment)
  WHEN 11 THEN 'lum  1'
  WHEN 12 THEN 'LUM 1'
  WHEN 13 THEN concat(c_mktsegment, '-', CAST(c_custkey % 3 AS {text}))
  WHEN 14 THEN 'PROVI'
  ELSE concat('Ward ', CAST(c_custkey % 12 AS {text}), ' absentee by mail') END"""
_LABEL_COUNTY = "CASE c_custkey % 7 WHEN 0 THEN 'ROBESON' WHEN 1 THEN 'WAKE' WHEN 2 THEN 'MECKLENBURG' WHEN 3 THEN 'caswell ' ELSE 'UNION' END"
LAB = f"lab AS (SELECT c_custkey AS k, {_LABEL_COUNTY} AS county, {_LABEL.format(text='VARCHAR')} AS label FROM customer)"


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.expr(_LABEL_COUNTY).alias("county"), F.expr(_LABEL.format(text="STRING")).alias("label"))


#: Office labels derived from parts.
_OFFICE = """CASE p_partkey % 14
  WHEN 0 THEN 'US PRESIDENT' WHEN 1 THEN ' us  senate (VOTE FOR 1)' WHEN 2 THEN concat('NC COURT OF APPEALS JUDGE SEAT ', CAST(p_partkey % 15 AS {text}))
  WHEN 3 THEN 'SUPREME COURT ASSOCIATE JUSTICE (EDMUNDS-HILL SEAT)' WHEN 4 THEN 'NC SUPREME COURT CHIEF JUSTICE' WHEN 5 THEN 'Court of Appeals Judge - Tyson Seat'
  WHEN 6 THEN 'NC COURT OF APPEALS JUDGE (DAVIS)' WHEN 7 THEN concat('NC STATE HOUSE DISTRICT ', lpad(CAST(p_partkey % 120 + 1 AS {text}), 3, '0'))
  WHEN 8 THEN concat('NC STATE SENATE DISTRICT ', CAST(p_partkey % 50 + 1 AS {text})) WHEN 9 THEN 'PRESIDENT AND VICE PRESIDENT OF THE U.S.'
  WHEN 10 THEN 'NC LIEUTENANT GOVERNOR' WHEN 11 THEN 'Super. of Public Instruction' WHEN 12 THEN 'SHERIFF' ELSE 'NC GOVERNOR' END"""
OFF = f"off AS (SELECT p_partkey AS k, {_OFFICE.format(text='VARCHAR')} AS office FROM part)"


def offices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.expr(_OFFICE.format(text="STRING")).alias("office"))


#: Candidate names derived from suppliers.
_NAME = """CASE s_suppkey % 9
  WHEN 0 THEN 'DONALD J. TRUMP / J.D. VANCE' WHEN 1 THEN 'A. Gore-J. Lieberman' WHEN 2 THEN ' Phil  Berger, Jr. ' WHEN 3 THEN 'Ann Smith-Jones'
  WHEN 4 THEN 'X & Y' WHEN 5 THEN '' WHEN 6 THEN concat('Name ', CAST(s_suppkey AS {text})) WHEN 7 THEN 'BUSH-CHENEY' ELSE 'Obama - Biden' END"""
CAN = f"can AS (SELECT s_suppkey AS k, {_NAME.format(text='VARCHAR')} AS name, CAST(s_suppkey % 4 AS DOUBLE) AS votes FROM supplier)"


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.expr(_NAME.format(text="STRING")).alias("name"), (F.col("s_suppkey") % 4).cast("double").alias("votes"))


def oracle(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


#: Precinct rows of three parties from the geographic result rows.
PRE = """pre AS (
  SELECT year, office, county, concat(county, ' - ', precinct) AS precinct_id,
         sum(CASE WHEN party = 'DEM' THEN votes ELSE 0 END) AS dem_votes, sum(CASE WHEN party = 'REP' THEN votes ELSE 0 END) AS rep_votes,
         sum(CASE WHEN party NOT IN ('DEM', 'REP') THEN votes ELSE 0 END) AS other_votes
  FROM res WHERE precinct <> 'ABSENTEE' GROUP BY 1, 2, 3, 4)"""
#: County rows of three parties from all result rows.
CTY = PRE.replace("pre AS", "cty AS").replace(", concat(county, ' - ', precinct) AS precinct_id", "").replace(" WHERE precinct <> 'ABSENTEE' GROUP BY 1, 2, 3, 4", " GROUP BY 1, 2, 3")
