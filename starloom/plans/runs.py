"""Composite runs: E4 end-to-end (from a table or from files), E5 staged run, E3 alternate run.

E4: extract -> clean -> class distribution -> star -> publish.
E5: the same with a parquet hand-off after every stage (S6), constraint
checks, load verification (S11) and a run summary (A10).  Stages are written
to shared storage, so a lost executor only recomputes from the last stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starloom import spec as S
from starloom.operators.clean import clean_survey
from starloom.operators.profile import class_distribution, run_summary
from starloom.operators import views
from starloom.operators.numbering import BLOCK, FILE, POS, has_file_order, with_file_order
from starloom.operators.star import build_star
from starloom.session import reliable_checkpoint, scratch_scope
from starloom.sources import files, sinks


@dataclass
class RunResult:
    raw: DataFrame
    clean: DataFrame
    classes: DataFrame
    star: dict[str, DataFrame]
    published: dict[str, str] | None = None
    summary: DataFrame | None = None
    published_root: str | None = None


def extract(spark: SparkSession, in_dir: str, years: int | list[int] | None = None,
            first_rows: int | None = None, spec: S.SurveySpec = S.SURVEY,
            check_rows: bool = True) -> DataFrame:
    """One year (an int), some or all years, or the first rows, of a folder of yearly files."""
    if isinstance(years, int):
        raw = files.single_year(spark, in_dir, years, spec, file_order=True, check_rows=check_rows)
    else:
        raw = files.union_years(spark, in_dir, spec, years, file_order=True, check_rows=check_rows)
    return files.bounded_scan(raw, first_rows) if first_rows else raw


def run_files(spark: SparkSession, in_dir: str, out_root: str, years: int | list[int] | None = None,
              first_rows: int | None = None, binary_mode: str = "declared",
              order_key: str | None = None, layout: S.StarLayout = S.MAIN_STAR,
              spec: S.SurveySpec = S.SURVEY, check_rows: bool = True) -> dict[str, str]:
    """E4 from files to published tables; the paths of the published version.

    Rows are numbered in the order of the files unless ``order_key`` names a
    column.  Intermediate tables are removed once the star is published.
    """
    with scratch_scope(spark):
        raw = extract(spark, in_dir, years, first_rows, spec, check_rows)
        if first_rows:
            raw = reliable_checkpoint(raw, "first-rows")
            raw = with_row_order(raw)
        star = build_star(clean_survey(raw, spec, binary_mode), layout, spec, order_key)
        return sinks.publish_star(star, out_root, layout)


def with_row_order(rows: DataFrame) -> DataFrame:
    """A bounded, ordered selection keeps its order as the order of the files written from it."""
    return with_file_order(rows.drop(FILE, BLOCK, POS)) if has_file_order(rows) else rows


def run_alternate(spark: SparkSession, processed_csv: str, out_dir: str,
                  layout: S.StarLayout = S.ALT_STAR) -> tuple[dict[str, str], DataFrame, DataFrame]:
    """Processed CSV -> alternate star -> one CSV per table, samples, compression ratio."""
    star = build_star(files.dataset_scan(spark, processed_csv, file_order=True), layout)
    star = {name: reliable_checkpoint(df, name) for name, df in star.items()}
    paths = sinks.write_csv_tables(star, out_dir)
    return paths, views.head_sample(star, layout), views.compression_ratio(star, layout)


def end_to_end(raw: DataFrame, out_root: str | None = None,
               layout: S.StarLayout = S.MAIN_STAR, spec: S.SurveySpec = S.SURVEY,
               binary_mode: str = "declared", order_key: str | None = None) -> RunResult:
    """Clean, distribution, star, optional publish to ``out_root``."""
    clean = clean_survey(raw, spec, binary_mode)
    star = build_star(clean, layout, spec, order_key)
    published = sinks.publish_star(star, out_root, layout) if out_root else None
    return RunResult(raw, clean, class_distribution(clean), star, published,
                     published_root=out_root)


def staged_run(spark: SparkSession, raw: DataFrame, stage_root: str, out_root: str,
               layout: S.StarLayout = S.MAIN_STAR, spec: S.SurveySpec = S.SURVEY,
               binary_mode: str = "declared", order_key: str | None = None) -> RunResult:
    """E5: every stage handed off as parquet; verified; summarised."""
    root = stage_root.rstrip("/")
    raw_s = sinks.write_stage(raw, f"{root}/raw_extracted")
    clean_s = sinks.write_stage(clean_survey(raw_s, spec, binary_mode), f"{root}/cleaned_data")
    star = build_star(clean_s, layout, spec, order_key)
    staged = {name: sinks.write_stage(df, f"{root}/dimensional/{name}")
              for name, df in star.items()}
    published = sinks.publish_star(staged, out_root, layout)
    loaded = sinks.read_published(spark, out_root, layout)
    summary = run_summary(raw_s, clean_s, loaded)
    return RunResult(raw_s, clean_s, class_distribution(clean_s), staged, published, summary,
                     published_root=out_root)
