"""The query register and the roles that the given tables play.

A role is a list of expressions over one table, written in the part of SQL that Spark and the
checking engine share, so that both sides start from the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnos.session import new_path, spread

Runner = Callable[[SparkSession, str], DataFrame]

_RUNNERS: dict[str, Runner] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query and, where SQL can say it, the statement it must agree with."""

    def register(runner: Runner) -> Runner:
        if name in _RUNNERS:
            raise ValueError(f"query {name} is registered twice")
        _RUNNERS[name] = runner
        if sql is not None:
            _ORACLES[name] = sql
        return runner

    return register


def runners() -> dict[str, Runner]:
    return dict(_RUNNERS)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Role:
    """Named expressions over one table, usable from both engines.

    ``shared`` are parts that many expressions repeat. Spark works them out once a row: a part inside a CASE is otherwise
    worked out for each of its branches, and rounding a number costs more than all else.
    """

    def __init__(self, source: str, columns: dict[str, str], shared: Sequence[str] = ()) -> None:
        self.source, self.columns, self.shared = source, columns, shared

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df, columns = table(spark, sf_dir, self.source), self.columns
        for i, part in enumerate(self.shared):
            df = df.withColumn(f"_shared{i}", F.expr(part))
            columns = {n: e.replace(part, f"_shared{i}") for n, e in columns.items()}
        return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])

    @property
    def sql(self) -> str:
        return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in self.columns.items()) + f" FROM {self.source}"


# Orders as chemistry in long form: customer = site, priority = parameter, price in whole cents
# (whole numbers keep sums exact in any order), pending orders = missing values.
CHEMISTRY = Role(
    "orders",
    {
        "sample_id": "o_orderkey",
        "site": "o_custkey",
        "day": "CAST(o_orderdate AS DATE)",
        "yr": "CAST(year(o_orderdate) AS INT)",
        "code": "substring(o_orderpriority, 1, 1)",
        "val": "CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS DOUBLE) END",
        "full_val": "CAST(round(o_totalprice * 100) AS DOUBLE)",
        "status": "o_orderstatus",
    },
)

# Events as repeated measurements on one day.
MEASUREMENTS = Role(
    "events",
    {
        "site": "user_id",
        "day": "CAST(ts AS DATE)",
        "code": "event_type",
        "cents": "CASE WHEN value >= 1 THEN CAST(round(value * 100) AS DOUBLE) END",
        "unit": "CASE WHEN value < 2 THEN NULL WHEN value < 20 THEN 'mg' ELSE 'ug' END",
        "edited": "CAST(ts AS DATE)",
        "event_id": "event_id",
        "props": "props",
    },
)

_DISCOUNT = "CAST(round(l_discount * 100) AS INT)"
_TAX = "CAST(round(l_tax * 100) AS INT)"
_QUANTITY = "CAST(l_quantity AS INT)"

# Lineitems as laboratory values whose text holds decimal commas, limits, ranges and junk.
LAB = Role(
    "lineitem",
    {
        "sampleId": "l_orderkey * 10 + l_linenumber",
        "productType": "CASE WHEN l_linenumber < 7 THEN 'Chemistry' ELSE 'Biology' END",
        "stationId": "l_suppkey",
        "samplingSiteId": "l_suppkey",
        "samplingDate": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
        "lastEdit": "CAST(CAST(l_shipdate AS DATE) + l_linenumber AS STRING)",
        "minDepth": f"CASE WHEN {_DISCOUNT} = 9 THEN NULL ELSE CAST({_TAX} AS DOUBLE) END",
        "maxDepth": f"CASE WHEN {_DISCOUNT} >= 8 THEN NULL ELSE CAST({_TAX} + l_linenumber AS DOUBLE) END",
        "empty": f"({_DISCOUNT} = 10 AND {_TAX} = 0)",
        "warm": "(l_linestatus = 'O')",
        "propertyCode": "CASE WHEN l_returnflag = 'A' THEN 'Alk_Acid' WHEN l_returnflag = 'N' THEN 'Tot_P' "
                        "WHEN l_linestatus = 'F' THEN 'Farg' ELSE 'Ovrigt' END",
        "propertyAbbrevName": "CASE WHEN l_returnflag = 'A' THEN 'Alk/Acid' WHEN l_returnflag = 'N' THEN 'Tot-P' "
                              "WHEN l_linestatus = 'F' THEN 'Färg' ELSE 'Övr' END",
        "propertyName": "CASE WHEN l_returnflag = 'A' THEN 'Alkalinitet/Acid.' WHEN l_returnflag = 'N' "
                        "THEN 'Totalfosfor' WHEN l_linestatus = 'F' THEN 'Färgtal' ELSE 'Övrigt' END",
        "unit": "CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'R' THEN 'mgPt/l' "
                "WHEN l_linestatus = 'F' THEN 'mg/l' ELSE 'µg/l' END",
        "value": f"CASE WHEN {_DISCOUNT} = 0 THEN concat('<', CAST({_QUANTITY} AS STRING), ',', CAST({_TAX} AS STRING)) "
                 f"WHEN {_DISCOUNT} = 1 THEN concat('>', CAST({_QUANTITY} AS STRING)) "
                 f"WHEN {_DISCOUNT} = 2 THEN concat('(<', CAST({_QUANTITY} AS STRING), ',', CAST({_TAX} AS STRING), ')') "
                 f"WHEN {_DISCOUNT} = 3 THEN concat(CAST({_TAX} AS STRING), ',1-', CAST({_QUANTITY} AS STRING), ',2') "
                 f"WHEN {_DISCOUNT} = 4 THEN concat('-0,0', CAST({_TAX} AS STRING)) "
                 f"WHEN {_DISCOUNT} = 5 THEN 'abc' WHEN {_DISCOUNT} = 6 THEN NULL "
                 f"ELSE concat(CAST({_QUANTITY} AS STRING), ',', CAST({_TAX} AS STRING)) END",
        "warmth": f"concat(CAST({_TAX} AS STRING), ',5')",
    },
    shared=[_DISCOUNT, _TAX],
)

# The samples as landed: an array of observations, each with an array of values.
_OBSERVATION = (
    "named_struct('propertyCode', {code}, 'propertyAbbrevName', {abbrev}, 'propertyName', {name}, "
    "'sampleId', sampleId, 'observationId', {obs}, 'observationMetadata', array(named_struct('label', 'Djup', "
    "'value', CAST(minDepth AS STRING)), named_struct('label', 'Metod', 'value', productType)), "
    "'observationValues', array(named_struct('observationId', {obs}, 'name', {name}, 'value', {value}, 'unit', {unit})))"
)
_MAIN = _OBSERVATION.format(code="propertyCode", abbrev="propertyAbbrevName", name="propertyName",
                            obs="sampleId * 2", value="value", unit="unit")
_WARM = _OBSERVATION.format(code="'Temp'", abbrev="'Temp'", name="'Vattentemperatur'", obs="sampleId * 2 + 1",
                            value="warmth", unit="'°C'")
SAMPLE_COLUMNS = ["sampleId", "productType", "stationId", "samplingSiteId", "samplingDate", "lastEdit",
                  "minDepth", "maxDepth"]


_LANDED: dict[tuple[str, str, str], str] = {}


def landed_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived input, written to the shared folder by the first query of an application that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = new_path(spark, name)
        build().write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def lab_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested laboratory samples, each built from its own row, so nothing is grouped; for queries that land them themselves."""
    return spread(LAB.df(spark, sf_dir)).selectExpr(
        *SAMPLE_COLUMNS,
        f"slice(array({_MAIN}, {_WARM}), 1, CASE WHEN empty THEN 0 WHEN warm THEN 2 ELSE 1 END) AS observations",
    )


def lab_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as landed once for an application."""
    return landed_once(spark, sf_dir, "lab-samples", lambda: lab_rows(spark, sf_dir))


LAB_LONG_SQL = f"""
lab AS ({LAB.sql}),
lab_long AS (
  SELECT {", ".join(SAMPLE_COLUMNS)}, propertyCode, propertyAbbrevName, propertyName, value, unit,
         sampleId * 2 AS observationId
  FROM lab WHERE NOT empty
  UNION ALL
  SELECT {", ".join(SAMPLE_COLUMNS)}, 'Temp', 'Temp', 'Vattentemperatur', warmth, '°C', sampleId * 2 + 1
  FROM lab WHERE NOT empty AND warm
)"""

# Numeric lineitem columns with missing cells, for profiling and correlation.
_PROFILE = {
    "qty": "CASE WHEN l_returnflag <> 'R' THEN l_quantity END",
    "price": "l_extendedprice",
    "disc": "CASE WHEN l_linestatus = 'O' OR l_tax > 0.02 THEN l_discount END",
    "tax": "l_tax",
    "line": "CAST(l_linenumber AS DOUBLE)",
    "nothing": "CASE WHEN l_quantity < 0 THEN l_quantity END",
    "same": "CASE WHEN l_quantity >= 0 THEN 7.0e0 ELSE 7.0e0 END",
    "half": "CASE WHEN l_linestatus = 'O' THEN 3.0e0 END",
}
PROFILE = Role("lineitem", {"flag": "l_returnflag", "supp": "l_suppkey", **_PROFILE})
PROFILE_NUMBERS = list(_PROFILE)

# Parts as taxon records.
TAXA = Role(
    "part",
    {
        "part_id": "p_partkey",
        "plain": "p_name",
        "recorded": "CASE WHEN p_type = 'ECONOMY' THEN concat(' ', upper(p_name), '  ') "
                    "WHEN p_type = 'STANDARD' THEN concat(p_name, ' var. Alba minor') "
                    "WHEN p_type = 'LARGE' THEN concat(p_name, ' x ', p_brand) "
                    "WHEN p_type = 'MEDIUM' THEN concat(p_name, ' agg.') "
                    "WHEN p_size < 10 THEN 'Inget fynd' WHEN p_size < 20 THEN 'iris' "
                    "WHEN p_size < 30 THEN NULL ELSE concat(p_name, ' s. lat.') END",
        "brand": "p_brand",
        "size": "p_size",
    },
)
