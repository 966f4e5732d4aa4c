"""Composite plans on landed documents made by hand."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnos import fixed_values as fixed
from limnos import registry, session
from limnos.plans import laboratory as P
from limnos.plans import site_years as Y
from limnos.plans import surveys as V
from limnos.session import new_path
from limnos.sources import landed


def fields(**kinds):
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()
ENTRY = fields(label=S, value=S)
LAB_VALUE = fields(observationId=I, name=S, value=S, unit=S)
LAB_OBSERVATION = fields(observationId=I, sampleId=I, propertyCode=S, propertyAbbrevName=S, propertyName=S,
                         observationValues=T.ArrayType(LAB_VALUE))
LAB_SAMPLE = fields(sampleId=I, productType=S, samplingDate=S, lastEdit=S, samplingSiteId=I, samplingSiteName=S, samplingSiteX=S,
                    samplingSiteY=S, minDepth=D, maxDepth=D, stationId=I, stationName=S, county=S, municipality=S,
                    observations=T.ArrayType(LAB_OBSERVATION))
PLANT_VALUE = fields(observationId=I, value=S)
PLANT_OBSERVATION = fields(observationId=I, qualityCode=S, analysisDate=S, propertyName=S, observationValues=T.ArrayType(PLANT_VALUE),
                           observationMetadata=T.ArrayType(ENTRY))
INDEX = fields(indexShortName=S, indexValue=S, inputValuesText=S)
PLANT_SAMPLE = fields(sampleId=I, samplingSiteId=I, samplingDate=S, samplingSiteX=S, samplingSiteY=S, observationCount=I, stationId=I,
                      sampleMetadata=T.ArrayType(ENTRY), sampleIndices=T.ArrayType(fields(indexQualityFlag=S, indexList=T.ArrayType(INDEX))),
                      observations=T.ArrayType(PLANT_OBSERVATION))


def land(path, samples, array="samples", per_line=False):
    path.mkdir()
    if per_line:
        (path / "a.json").write_text("\n".join(json.dumps({array: [s]}) for s in samples))
    else:
        (path / "a.json").write_text(json.dumps({array: samples}, indent=1))
    return str(path)


def lab(number, code, abbrev, name, value, unit, low, high, station=1, day="2015-07-01", edit="2016-01-01"):
    observed = [] if code is None else [{
        "observationId": number, "sampleId": number, "propertyCode": code, "propertyAbbrevName": abbrev, "propertyName": name,
        "observationValues": [{"observationId": number, "name": name, "value": value, "unit": unit}]}]
    return {"sampleId": number, "productType": "Chemistry", "samplingDate": day, "lastEdit": edit + "T10:00:00", "samplingSiteId": 10 + station,
            "samplingSiteX": "1", "samplingSiteY": "2", "minDepth": low, "maxDepth": high, "stationId": station, "observations": observed}


LAB = [
    lab(1, "Tot_P", "Tot-P", "Totalfosfor", "1,25", "mg/l", 0.5, 0.5),
    lab(2, "Tot_P", "Tot-P", "Totalfosfor", "<0,5", "mg/l", 0.5, 0.5, edit="2017-01-01"),
    lab(3, "Tot_P", "Tot-P", "Totalfosfor", "9", "µg/l", 0.5, 2.0),
    lab(4, "Tot_P", "Tot-P", "Totalfosfor", "7", "µg/l", 5.0, 5.0),
    lab(5, "Alk_Acid", "Alk/Acid", "Alkalinitet/Acid.", "-0,03", None, None, None),
    lab(6, "Alk", "Alk.", "Alkalinitet", "0,2", "mekv/l", None, None),
    lab(7, "Tot_P", "Tot-P", "Totalfosfor", "(<0,5)", "µg/l", 0.0, 0.0),
    lab(8, None, None, None, None, None, 0.0, 0.0),
    lab(9, "Cd", "Cd", "Kadmium", "1", "µg/l", 0.0, 0.0),
    lab(10, "Tot_P", "Tot-P", "Totalfosfor", "3", "µg/l", 0.5, 0.5, station=9),
    lab(11, "Farg", "Färg", "Färgtal", "30", "okänd", 0.5, 0.5),
]


@pytest.mark.parametrize("per_line", [True, False])
def test_laboratory_from_documents(spark, tmp_path, per_line):
    samples = landed.scan_samples(spark, land(tmp_path / "lab", LAB, per_line=per_line), LAB_SAMPLE, one_document_per_line=per_line)
    stations = landed.scan_samples(spark, land(tmp_path / "stations", [{"stationId": 1}, {"stationId": 2}], "stations", per_line),
                                   fields(stationId=I), "stations", per_line)
    (tmp_path / "units.csv").write_text("id,a,b,c,d,e,f,g\n1,Tot-P,mg/l,µg/l,1000,,,3\n2,Tot-P,µg/l,µg/l,\"1\",,,3\n3,Alk/Acid,NA,mekv/l,\"0,001\",,,3\n"
                                        "4,Alk.,mekv/l,mekv/l,1,,,3\n")
    units = landed.scan_unit_dictionary(spark, str(tmp_path / "units.csv"))
    clean = P.chemistry_clean(samples, stations, units, "Chemistry", (2005, 2025))
    got = {(r["propertyName"]): r for r in clean.collect()}
    assert set(got) == {"Totalfosfor", "Alkalinitet/Acid.", "Alkalinitet", "Färgtal"}
    assert got["Totalfosfor"]["val"] == pytest.approx((1250 + 250) / 2) and got["Totalfosfor"]["lastEditDate"] == date(2017, 1, 1)
    # both sources of alkalinity lack a depth, so they tie and both stay
    assert got["Alkalinitet/Acid."]["val"] == 0.0 and got["Alkalinitet/Acid."]["propertyAbbrevName"] == "Alk."
    assert got["Alkalinitet"]["val"] == 0.2 and got["Färgtal"]["val"] is None and got["Färgtal"]["unitF"] is None


def test_units_are_sent_to_the_values(spark):
    """Of unknown size, the dictionary would have all values dealt by a handful of units."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        plan = registry.runners()["harmonise_units"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_laboratory_years_are_filtered(spark, tmp_path):
    samples = landed.scan_samples(spark, land(tmp_path / "lab", LAB), LAB_SAMPLE, one_document_per_line=False)
    stations = samples.select("stationId").distinct()
    assert landed.restrict_to_stations(samples, stations, "Chemistry", (2016, 2020)).count() == 0
    assert landed.restrict_to_stations(samples, stations, "Biology").count() == 0


def plant(number, site, day, taxa, x="1", y="2", count=1, metadata=(), indices=(), extra=()):
    return {"sampleId": number, "samplingSiteId": site, "samplingDate": day, "samplingSiteX": x, "samplingSiteY": y, "observationCount": count,
            "stationId": site, "sampleMetadata": [{"label": k, "value": v} for k, v in metadata],
            "sampleIndices": [{"indexQualityFlag": "a", "indexList": list(indices)}] if indices else [],
            "observations": [{"observationId": number * 10 + i, "qualityCode": "N/A", "analysisDate": day, "propertyName": t,
                              "observationValues": [{"observationId": number * 10 + i, "value": "1"}],
                              "observationMetadata": [{"label": k, "value": v} for k, v in extra]} for i, t in enumerate(taxa)]}


RANK = "Dominerande oorganiskt bottensubstrat enligt Undersökningstyp v3"
METHOD = "Provtagningsmetod (biologisk provtagning)"
PLANTS = [
    plant(1, 1, "2010-08-01", ["Iris", "Carex × saamica"], count=2, metadata=[("Siktdjup (m)", "1,8-4,5"), ("Sjösänkning", "Uppgift saknas")],
          indices=[{"indexShortName": "Mfr arter", "indexValue": "12.0"}, {"indexShortName": "TMI", "indexValue": "7.5 p",
                    "inputValuesText": "Summa produkt=55.6;Summa viktfaktor=7.3"}, {"indexShortName": None, "indexValue": None}],
          extra=[("Vattendjup (m)", "1,5"), (RANK, "Sten >63-200 mm"), (METHOD, "Kratta")]),
    plant(2, 1, "2010-08-01", ["Iris", "Iris", "Chara s.lat."], count=5),
    plant(3, 1, "2012-08-01", ["Isoëtes lacustris"], count=9),
    plant(4, 2, "2011-07-01", ["Inget fynd"], x=None),
    plant(5, 3, "2011-07-01", ["Iris"], x=None, y=None),
    plant(6, 4, "2009-07-01", [], metadata=[("Siktdjup (m)", ">4")]),
    plant(7, 6679, "2009-07-01", ["Iris"]),
]


def plant_samples(spark, tmp_path):
    return landed.scan_samples(spark, land(tmp_path / "plants", PLANTS), PLANT_SAMPLE, one_document_per_line=False)


def test_survey_base_is_one_row_per_sample(spark, tmp_path):
    base, observations = V.survey_flatten(plant_samples(spark, tmp_path))
    assert base.count() == len(PLANTS) and observations.count() == 10
    first = base.filter("sampleId = 1").first()
    assert (first["rich"], first["tmiRich"], first["tmi"]) == ("12.0", None, "7.5")
    assert (first["productSum"], first["weightFactorSum"], first["secchi"]) == ("55.6", "7.3", "1,8-4,5")


def test_attributes_without_variation_are_pruned(spark, tmp_path):
    samples = plant_samples(spark, tmp_path).withColumn("fixed", F.lit(1)).withColumn("none", F.lit(None).cast("string"))
    pruned = V.prune_by_content(samples)
    assert not {"fixed", "none"} & set(pruned.columns) and {"sampleId", "observations", "samplingSiteId"} <= set(pruned.columns)
    base, _ = V.survey_flatten(samples, prune=True)
    assert base.count() == len(PLANTS)


def test_survey_selection_and_community(spark, tmp_path):
    samples = plant_samples(spark, tmp_path)
    chosen, taxa = V.community_surveys(samples)
    by_site = {r["samplingSiteId"]: r for r in chosen.collect()}
    assert {k: r["sampleId"] for k, r in by_site.items()} == {1: 2, 2: 4, 4: 6}
    assert by_site[4]["secchi"] == pytest.approx(4.4) and by_site[2]["samplingYr"] == 2011
    assert sorted((r["sampleId"], r["taxaClean"], r["value"]) for r in taxa.collect()) == [(2, "Chara", 1.0), (2, "Iris pseudacorus", 2.0)]
    table = V.community_table(samples, ["Iris pseudacorus", "Chara", "Carex", "Biota"])
    assert "Biota" not in table.columns and "sampleId" not in table.columns
    assert {r["samplingSiteId"]: (r["Carex"], r["Chara"], r["Iris pseudacorus"]) for r in table.collect()} == {
        1: (0.0, 1.0, 2.0), 2: (0.0, 0.0, 0.0), 4: (0.0, 0.0, 0.0)}


def test_only_selected_surveys_are_parsed(spark, tmp_path, monkeypatch):
    parsed, parse = [], V.survey_base
    monkeypatch.setattr(V, "survey_base", lambda samples: parsed.append(sorted(r["sampleId"] for r in samples.collect())) or parse(samples))
    chosen, _ = V.community_surveys(plant_samples(spark, tmp_path))
    assert parsed == [[2, 4, 6]]
    assert sorted(r["sampleId"] for r in chosen.collect()) == [2, 4, 6]


def test_survey_covariates(spark, tmp_path):
    taxa = V.survey_taxa(V.survey_observations(plant_samples(spark, tmp_path)))
    first = V.survey_covariates(taxa).filter("sampleId = 1").first()
    assert (first["waterDepthMin"], first["inorgSubstrateMed"], first["sampleRake"], first["sampleDive"]) == (1.5, 4.0, 2, 0)
    assert taxa.filter("sampleId = 6").first()["taxaClean"] == fixed.PLACEHOLDER_TAXON


def test_taxa_of_surveys_are_dealt_by_their_number(spark, monkeypatch):
    """Not by bytes, in which rows that repeat few texts are small; and names, being few, are sent to the rows."""
    monkeypatch.setattr(session, "ROWS_A_TASK", 20)
    rows = [(n, "2010-08-01", "N/A", "2010-08-01", t, "1") for n in range(200) for t in ("Iris", "Carex × saamica")]
    kinds = "sampleId int, samplingDate string, qualityCode string, analysisDate string, propertyName string, value string"
    observed = spark.createDataFrame(rows, kinds).withColumns({n: F.lit(None).cast("string") for n in fixed.OBSERVATION_METADATA_NAMES.values()})
    taxa = V.survey_taxa(observed)
    assert sorted((r["sampleId"], r["taxaClean"]) for r in taxa.collect()) == sorted((n, t) for n in range(200) for t in ("Iris pseudacorus", "Carex"))
    assert taxa.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0] <= 60
    assert "SortMergeJoin" not in taxa._jdf.queryExecution().executedPlan().toString()


def test_site_years_and_richness(spark, tmp_path):
    chemistry = spark.createDataFrame(
        [(1, "2010-07-01", "Tot_P", 10.0), (1, "2010-05-01", "Tot_P", 5.0), (1, "2010-01-01", "Tot_N", 3.0), (1, "2010-07-05", "Tot_N_ps", 8.0),
         (1, "2010-07-05", "Tot_N_TNb", None), (1, "2010-07-05", "NO3_N", 1.0), (1, "2011-07-01", "Tot_P", 99.0), (8, "2010-07-01", "Tot_P", 1.0),
         (1, "2010-07-01", "Turb_FNU", 2.0)],
        "samplingSiteId int, samplingDate string, propertyCode string, val double")
    surveys = spark.createDataFrame([(100, 1, 2010), (101, 1, 2010), (102, 2, 2010)], "sampleId int, samplingSiteId int, samplingYr int")
    codes = ["Tot_P", "Tot_N", "Tot_N_ps", "Tot_N_TNb", "NO3_N", "Turb_FNU"]
    wide = Y.site_year_chemistry(chemistry, surveys, codes)
    assert wide.columns == ["samplingSiteId", "samplingYr", "Tot_P", "TN"]
    assert [tuple(r) for r in wide.collect()] == [(1, 2010, 8.0, 8.0)]
    (tmp_path / "list.csv").write_text("Species,Synonym\nAcorus  calamus,\nIris pseudacorus var. x,Carex lasiocarpa subsp. y\nCarex,M. alba\n")
    reference = landed.scan_reference_list(spark, str(tmp_path / "list.csv"))
    assert {r[0] for r in Y.reference_taxa(reference).collect()} == {"Acorus", "Iris pseudacorus", "Iris", "Carex lasiocarpa", "M. alba", None}
    taxa = spark.createDataFrame([(100, "Iris pseudacorus", 1.0), (100, "Carex", 1.0), (101, "Iris", 3.0)], "sampleId int, taxaClean string, value double")
    joined = Y.richness_join(surveys, taxa, reference, wide)
    assert sorted((r["sampleId"], r["maxRich"], r["murphyRich"], r["TN"]) for r in joined.collect()) == [
        (100, 2, 1, 8.0), (101, 1, 1, 8.0), (102, 0, 0, None)]


def test_saved_tables_keep_nested_types(spark, tmp_path):
    samples = plant_samples(spark, tmp_path)
    again = landed.save_and_reload(samples, new_path(spark, "test"))
    assert again.schema == samples.schema and again.count() == samples.count()


def test_batches_with_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q", 2)], "y string, x int")
    out = landed.union_evolving(a, b, schema=fields(x=T.LongType(), y=S, z=D))
    assert out.dtypes == [("x", "bigint"), ("y", "string"), ("z", "double")]
    assert sorted(map(tuple, out.collect())) == [(1, None, None), (2, "q", None)]


def test_correlation_tables_use_report_names(spark):
    from limnos.plans.reporting import correlation_tables

    names = {**fixed.CORRELATION_COLUMNS, **fixed.CORRELATION_COLUMNS_FULL}
    rows = [tuple(float((i * k) % 7 + i) if not (i == 2 and k > 12) else None for k in range(1, len(names) + 1)) for i in range(1, 9)]
    few, full = correlation_tables(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)))
    assert few.count() == 45 and full.count() == 153
    assert {"WFD Richness", "TP"} <= {r["a"] for r in full.collect()} | {r["b"] for r in full.collect()}


def test_documents_are_landed_compressed_and_read_back_whole(spark, tmp_path):
    rows = spark.range(250).selectExpr("id AS sampleId", "concat('text ', id) AS note", "array(named_struct('label', 'a', 'value', CAST(id AS STRING))) AS entries")
    path = str(tmp_path / "documents")
    landed.sink_documents(rows.coalesce(1), path, rows_per_file=100)
    files = [f.name for f in (tmp_path / "documents").iterdir() if f.name.startswith("part-")]
    assert len(files) == 3 and all(name.endswith(".snappy") for name in files)
    assert sorted(landed.scan_samples(spark, path, rows.schema).collect()) == sorted(rows.collect())


def test_a_role_works_out_shared_parts_once(spark):
    """Rounding stands once in the plan for each part that is rounded, however many columns and branches read it."""
    from limnos.registry import core, plants

    for role, parts in ((core.LAB, 2), (plants.PLANTS, 1)):
        plan = role.df(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("round(") == parts


def test_unit_report_counts_its_groups_in_one_pass(spark):
    rows = [(1, "2020-01-01", "pH", 0.0, 1.0, unit, "c", "n") for unit in ("a", "b")] + [(2, "2020-01-01", "pH", 0.0, 1.0, "a", "c", "n")] * 2
    values = spark.createDataFrame(rows, "stationId int, samplingDate string, propertyAbbrevName string, minDepth double, maxDepth double, "
                                         "unit string, propertyCode string, propertyName string")
    means = values.withColumn("samplingSiteId", F.col("stationId")).distinct()
    report = P.unit_quality_report(values, values, means)
    assert {r["measure"]: r["value"] for r in report.collect()} == {
        "extra_units": 1.0, "duplicate_groups": 2.0, "mixed_unit_groups": 1.0, "depth_duplicate_rate": pytest.approx(1 / 3)}
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sum(_n") == 1
