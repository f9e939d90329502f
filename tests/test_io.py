"""CSV export / import of the feature table, with and without a pandas index column."""

import datetime as dt

from wardflow.profiles import clinical as P
from wardflow.session import shared_dir
from wardflow.sources import io


def _row(i):
    vals = {c: None for c in P.MODEL_DATA_COLUMNS}
    vals.update(subject_id=i, hadm_id=100 + i, race="A B/C", admittime=dt.datetime(2100, 1, 1, 3),
                top_drg_code="0042", proc_icd_codes="", readmission_flag=1)
    return tuple(vals[c] for c in P.MODEL_DATA_COLUMNS)


def test_csv_roundtrip_keeps_codes_and_nulls(spark):
    odd = ["", None, ' a "q" ', "x,y", "two\nlines", "  ", '"', "\\", "0042", "tab\t", "NULL", "'"]
    rows = [_row(i) for i in range(len(odd))]
    at = P.MODEL_DATA_COLUMNS.index("diag_icd_codes")
    rows = [r[:at] + (v,) + r[at + 1:] for r, v in zip(rows, odd)]
    df = spark.createDataFrame(rows, io.model_data_schema())
    path = io.write_feature_csv(df, shared_dir(spark, "test_csv"))
    back = io.read_feature_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_with_index_column(spark, tmp_path):
    p = tmp_path / "x.csv"
    header = ",".join([""] + P.MODEL_DATA_COLUMNS)
    fields = ["0", "7", "8", "R"] + [""] * (len(P.MODEL_DATA_COLUMNS) - 3)
    p.write_text(header + "\n" + ",".join(fields) + "\n")
    back = io.read_feature_csv(spark, str(p), with_index=True, null_value="")
    r = back.collect()[0]
    assert back.columns == P.MODEL_DATA_COLUMNS and (r["subject_id"], r["hadm_id"], r["race"]) == (7, 8, "R")
