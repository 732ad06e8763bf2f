"""Catalogue of evaluation sets: a name resolves to (repo, subset, split) and to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE_SCHEMA = "name STRING, repo STRING, subset STRING, split STRING"

# Name, repo, subset, split. ``{home}`` stands for the hub namespace that keeps copies of
# the sets without a published home; it is an argument of ``default_catalogue``.
EVAL_SETS = (
    ("MSR-VTT", "friedrichor/MSR-VTT", "test_1k", "test"),
    ("MSVD", "friedrichor/MSVD", None, "test"),
    ("DiDeMo", "friedrichor/DiDeMo", None, "test"),
    ("YouCook2", "lmms-lab/YouCook2", None, "val"),
    ("VATEX", "lmms-lab/VATEX", None, "test"),
    ("HMDB51", "{home}/HMDB51", None, "test"),
    ("UCF101", "{home}/UCF101", None, "test"),
    ("Breakfast", "{home}/Breakfast", None, "test"),
    ("Kinetics-700", "{home}/Kinetics-700", None, "test"),
    ("SmthSmthV2", "{home}/SmthSmthV2", None, "test"),
    ("QVHighlight", "{home}/QVHighlight", None, "test"),
    ("Charades-STA", "{home}/Charades-STA", None, "test"),
    ("MomentSeeker", "{home}/MomentSeeker", None, "test"),
    ("ViDoRe_arxivqa", "vidore/arxivqa_test_subsampled_beir", None, "test"),
    ("ViDoRe_docvqa", "vidore/docvqa_test_subsampled_beir", None, "test"),
    ("ViDoRe_infovqa", "vidore/infovqa_test_subsampled_beir", None, "test"),
    ("ViDoRe_tabfquad", "vidore/tabfquad_test_subsampled_beir", None, "test"),
    ("ViDoRe_tatdqa", "vidore/tatdqa_test_beir", None, "test"),
    ("ViDoRe_shiftproject", "vidore/shiftproject_test_beir", None, "test"),
    ("ViDoRe_syntheticDocQA_artificial_intelligence",
     "vidore/syntheticDocQA_artificial_intelligence_test_beir", None, "test"),
    ("ViDoRe_syntheticDocQA_energy", "vidore/syntheticDocQA_energy_test_beir", None, "test"),
    ("ViDoRe_syntheticDocQA_government_reports",
     "vidore/syntheticDocQA_government_reports_test_beir", None, "test"),
    ("ViDoRe_syntheticDocQA_healthcare_industry",
     "vidore/syntheticDocQA_healthcare_industry_test_beir", None, "test"),
    ("VisRAG_ArxivQA", "openbmb/VisRAG-Ret-Test-ArxivQA", None, "train"),
    ("VisRAG_ChartQA", "openbmb/VisRAG-Ret-Test-ChartQA", None, "train"),
    ("VisRAG_MP-DocVQA", "openbmb/VisRAG-Ret-Test-MP-DocVQA", None, "train"),
    ("VisRAG_SlideVQA", "openbmb/VisRAG-Ret-Test-SlideVQA", None, "train"),
    ("VisRAG_InfoVQA", "openbmb/VisRAG-Ret-Test-InfoVQA", None, "train"),
    ("VisRAG_PlotQA", "openbmb/VisRAG-Ret-Test-PlotQA", None, "train"),
    ("ViDoSeek-doc", "{home}/ViDoSeek", None, "test"),
    ("ViDoSeek-page", "{home}/ViDoSeek-page", None, "test"),
    ("MMLongBench-doc", "{home}/MMLongBench-doc", None, "test"),
    ("MMLongBench-page", "{home}/MMLongBench", None, "test"),
    ("ViDoRe_esg_reports_human_labeled_v2", "vidore/esg_reports_human_labeled_v2", None, "test"),
    ("ViDoRe_biomedical_lectures_v2", "vidore/biomedical_lectures_v2", "english", "test"),
    ("ViDoRe_biomedical_lectures_v2_multilingual", "vidore/biomedical_lectures_v2", None, "test"),
    ("ViDoRe_economics_reports_v2", "vidore/economics_reports_v2", "english", "test"),
    ("ViDoRe_economics_reports_v2_multilingual", "vidore/economics_reports_v2", None, "test"),
    ("ViDoRe_esg_reports_v2", "vidore/esg_reports_v2", "english", "test"),
    ("ViDoRe_esg_reports_v2_multilingual", "vidore/esg_reports_v2", None, "test"),
)


def default_catalogue(spark: SparkSession, home: str) -> DataFrame:
    rows = [(name, repo.format(home=home), subset, split) for name, repo, subset, split in EVAL_SETS]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def _given(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def resolve(names: DataFrame, catalogue: DataFrame, root: str = "") -> DataFrame:
    """Where to read each requested name: which of subset and split apply, and the folder.

    A name the catalogue lacks stays with a NULL location.
    """
    found = names.select("name").join(catalogue, "name", "left")
    rule = (
        F.when(F.col("repo").isNull(), F.lit("unknown"))
        .when(_given("subset") & _given("split"), F.lit("subset_and_split"))
        .when(_given("subset"), F.lit("subset"))
        .when(_given("split"), F.lit("split"))
        .otherwise(F.lit("whole"))
    )
    parts = [F.when(_given(c), F.col(c)) for c in ("repo", "subset", "split")]
    base = [F.lit(root.rstrip("/"))] if root else []
    location = F.when(F.col("repo").isNotNull(), F.concat_ws("/", *base, *parts))
    return found.withColumn("rule", rule).withColumn("location", location)


def load_sets(spark: SparkSession, names: list[str], catalogue: DataFrame, root: str) -> DataFrame:
    """Read the requested sets from ``root`` and stack them with a ``dataset`` tag."""
    wanted = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "name STRING")
    entries = resolve(wanted, catalogue, root).collect()  # one row per requested name
    unknown = [e["name"] for e in entries if e["location"] is None]
    if unknown:
        raise KeyError(f"not in the catalogue: {unknown}")
    out = None
    for e in entries:
        reader = spark.read
        if e["rule"] in ("subset", "whole"):
            reader = reader.option("recursiveFileLookup", "true")
        part = reader.parquet(e["location"]).withColumn("dataset", F.lit(e["name"]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
