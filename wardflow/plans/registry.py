"""Named queries over the test data: name -> callable(spark, sf_dir) -> DataFrame.

Every query derives the hospital tables from the given test tables
(``wardflow.sources.synthetic``) and runs one operator or plan over all of
their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.plans import clinical as C
from wardflow.plans import learning, modelling
from wardflow.sources.synthetic import tables

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables(spark, sf_dir), **kw)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _scan_admissions(t):
    return t.admissions


def _age_score(t):
    from wardflow.functions.scores import score_bands
    from wardflow.profiles import clinical as P
    a = C.age(t)
    return a.select("subject_id", "hadm_id", "age", score_bands("age", P.AGE_SCORE_CUTS).alias("age_score"))


CORE: dict[str, Query] = {
    "scan_admissions": _q(_scan_admissions),
    "age_at_admission": _q(C.age),
    "readmission": _q(C.readmission, ranges=True),
    "readmission_calendar": _q(C.readmission, unit="calendar", ranges=True),
    "admission_ordinal": _q(C.admission_ordinal, ranges=True),
    "proc_count": _q(C.proc_count),
    "proc_distinct": _q(C.proc_distinct),
    "diag_distinct": _q(C.diag_distinct),
    "drug_distinct": _q(C.drug_distinct),
    "prescription_totals": _q(C.prescription_totals),
    "proc_sequence": _q(C.proc_sequence),
    "diag_sequence": _q(C.diag_sequence),
    "drg_sequence": _q(C.drg_sequence),
    "drg_top": _q(C.drg_top),
    "emar_count": _q(C.emar_count),
    "lab_abnormal_count": _q(C.lab_abnormal_count),
    "prev_visits": _q(C.prev_visits, ranges=True),
    "prev_transfers": _q(C.prev_transfers, ranges=True),
    "comorbidity_flags": _q(C.comorbidity_flags),
    "age_score": _q(_age_score),
    "charlson_index": _q(C.comorbidity_index),
    "model_data": _q(C.model_data, ranges=True),
    "model_data_bucketed": _q(C.model_data_bucketed),
}


def queries() -> dict[str, Query]:
    return CORE | modelling.QUERIES | {run.__name__: _q(run) for run in learning.RUNS}
