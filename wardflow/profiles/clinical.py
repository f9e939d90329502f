"""Clinical profile: column names and the fixed value lists the features depend on.

Everything in the FIXED VALUES blocks below must stay equal to the published
definitions (the Charlson categories as coded by Quan et al. 2005, the Charlson
1987 weights, the care-unit groups and the admission-location buckets); results
change if any entry changes.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Table / column names of the hospital schema.
# ---------------------------------------------------------------------------
ENTITY = "subject_id"
EPISODE = "hadm_id"
STAY_KEYS = [ENTITY, EPISODE]

# ---------------------------------------------------------------------------
# FIXED VALUES: admission-location buckets for the prior-visit counts.
# "emergency" counts locations equal to EMERGENCY_LOCATION; "non-emergency"
# counts locations NOT IN NON_EMERGENCY_EXCLUDED (NULL counts in neither).
# ---------------------------------------------------------------------------
EMERGENCY_LOCATION = "EMERGENCY ROOM"
NON_EMERGENCY_EXCLUDED = ("EMERGENCY ROOM", "INTERNAL TRANSFER TO OR FROM PSYCH")

# ---------------------------------------------------------------------------
# FIXED VALUES: care-unit groups for the prior-transfer counts.
# Units in no group are counted nowhere.
# ---------------------------------------------------------------------------
CAREUNIT_GROUPS = {
    "num_prev_general_practice": (
        "Med/Surg", "Med/Surg/GYN", "Med/Surg/Trauma", "Medical/Surgical (Gynecology)",
        "Observation", "Discharge Lounge", "Emergency Department Observation",
        "Nursery", "Special Care Nursery (SCN)",
    ),
    "num_prev_general_surgery": (
        "Surgery", "Surgery/Trauma", "Surgery/Vascular/Intermediate",
        "Surgery/Pancreatic/Biliary/Bariatric", "Surgical Intermediate",
        "Surgical Intensive Care Unit (SICU)", "Cardiac Surgery", "Thoracic Surgery",
        "Cardiology Surgery Intermediate",
    ),
    "num_prev_internal_medicine": (
        "Medicine", "Medicine/Cardiology", "Medicine/Cardiology Intermediate",
        "Cardiology", "Neurology", "Neuro Stepdown", "Neuro Intermediate",
        "Psychiatry", "Oncology", "Hematology/Oncology", "Hematology/Oncology Intermediate",
        "Vascular", "Transplant", "Intensive Care Unit (ICU)", "Medical Intensive Care Unit (MICU)",
        "Medical/Surgical Intensive Care Unit (MICU/SICU)", "Neuro Surgical Intensive Care Unit (Neuro SICU)",
        "Cardiac Vascular Intensive Care Unit (CVICU)", "Coronary Care Unit (CCU)",
    ),
}

# ---------------------------------------------------------------------------
# FIXED VALUES: Charlson comorbidity categories (Quan et al. 2005 coding).
# One line per category and ICD version:
#   <category> <version> <rule> <rule> ...
# A rule "n:a,b,c" means: the first n characters of the code are one of a, b, c.
# A rule "n:a..b" means: the first n characters lie between a and b (inclusive,
# binary string order). Categories are listed in output order.
# ---------------------------------------------------------------------------
CHARLSON_RULES = """
myocardial_infarct 9 3:410,412
myocardial_infarct 10 3:I21,I22 4:I252
congestive_heart_failure 9 3:428 5:39891,40201,40211,40291,40401,40403,40411,40413,40491,40493 4:4254..4259
congestive_heart_failure 10 3:I43,I50 4:I099,I110,I130,I132,I255,I420,I425,I426,I427,I428,I429,P290
peripheral_vascular_disease 9 3:440,441 4:0930,4373,4471,5571,5579,V434 4:4431..4439
peripheral_vascular_disease 10 3:I70,I71 4:I731,I738,I739,I771,I790,I792,K551,K558,K559,Z958,Z959
cerebrovascular_disease 9 3:430..438 5:36234
cerebrovascular_disease 10 3:G45,G46 3:I60..I69 4:H340
dementia 9 3:290 4:2941,3312
dementia 10 3:F00,F01,F02,F03,G30 4:F051,G311
chronic_pulmonary_disease 9 3:490..505 4:4168,4169,5064,5081,5088
chronic_pulmonary_disease 10 3:J40..J47 3:J60..J67 4:I278,I279,J684,J701,J703
rheumatic_disease 9 3:725 4:4465,7100,7101,7102,7103,7104,7140,7141,7142,7148
rheumatic_disease 10 3:M05,M06,M32,M33,M34 4:M315,M351,M353,M360
peptic_ulcer_disease 9 3:531,532,533,534
peptic_ulcer_disease 10 3:K25,K26,K27,K28
mild_liver_disease 9 3:570,571 4:0706,0709,5733,5734,5738,5739,V427 5:07022,07023,07032,07033,07044,07054
mild_liver_disease 10 3:B18,K73,K74 4:K700,K701,K702,K703,K709,K713,K714,K715,K717,K760,K762,K763,K764,K768,K769,Z944
diabetes_without_cc 9 4:2500,2501,2502,2503,2508,2509
diabetes_without_cc 10 4:E100,E101,E106,E108,E109,E110,E111,E116,E118,E119,E120,E121,E126,E128,E129,E130,E131,E136,E138,E139,E140,E141,E146,E148,E149
diabetes_with_cc 9 4:2504,2505,2506,2507
diabetes_with_cc 10 4:E102,E103,E104,E105,E107,E112,E113,E114,E115,E117,E122,E123,E124,E125,E127,E132,E133,E134,E135,E137,E142,E143,E144,E145,E147
paraplegia 9 3:342,343 4:3341,3440,3441,3442,3443,3444,3445,3446,3449
paraplegia 10 3:G81,G82 4:G041,G114,G801,G802,G830,G831,G832,G833,G834,G839
renal_disease 9 3:582,585,586,V56 4:5880,V420,V451 4:5830..5837 5:40301,40311,40391,40402,40403,40412,40413,40492,40493
renal_disease 10 3:N18,N19 4:I120,I131,N032,N033,N034,N035,N036,N037,N052,N053,N054,N055,N056,N057,N250,Z490,Z491,Z492,Z940,Z992
malignant_cancer 9 3:140..172 4:1740..1958 3:200..208 4:2386
malignant_cancer 10 3:C43,C88 3:C00..C26 3:C30..C34 3:C37..C41 3:C45..C58 3:C60..C76 3:C81..C85 3:C90..C97
severe_liver_disease 9 4:4560,4561,4562 4:5722..5728
severe_liver_disease 10 4:I850,I859,I864,I982,K704,K711,K721,K729,K765,K766,K767
metastatic_solid_tumor 9 3:196,197,198,199
metastatic_solid_tumor 10 3:C77,C78,C79,C80
aids 9 3:042,043,044
aids 10 3:B20,B21,B22,B24
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: Charlson index weights (Charlson 1987).
# Plain terms: weight * flag. Dominance pairs: greatest(w1 * flag1, w2 * flag2),
# so that the milder and the severe form of one disease are not both counted.
# ---------------------------------------------------------------------------
CHARLSON_WEIGHTS = {
    "myocardial_infarct": 1,
    "congestive_heart_failure": 1,
    "peripheral_vascular_disease": 1,
    "cerebrovascular_disease": 1,
    "dementia": 1,
    "chronic_pulmonary_disease": 1,
    "rheumatic_disease": 1,
    "peptic_ulcer_disease": 1,
    "paraplegia": 2,
    "renal_disease": 2,
    "aids": 6,
}
CHARLSON_DOMINANCE = [
    (("mild_liver_disease", 1), ("severe_liver_disease", 3)),
    (("diabetes_with_cc", 2), ("diabetes_without_cc", 1)),
    (("malignant_cancer", 2), ("metastatic_solid_tumor", 6)),
]

# FIXED VALUES: age bands of the Charlson age score: age <= 50 -> 0, <= 60 -> 1,
# <= 70 -> 2, <= 80 -> 3, otherwise (including unknown age) 4.
AGE_SCORE_CUTS = (50, 60, 70, 80)

# FIXED VALUES: the 30 output columns of the feature table, in order.
MODEL_DATA_COLUMNS = [
    "subject_id", "hadm_id", "race", "admittime", "dischtime", "hospital_expire_flag",
    "readmission_flag",
    "num_procedures", "num_unique_procedures", "num_unique_icd_codes", "num_unique_drugs",
    "num_prescribed_days", "num_prescription_records", "num_hospital_admissions",
    "proc_icd_codes", "diag_icd_codes", "drg_concat",
    "top_drg_code", "top_drg_type", "top_drg_severity", "top_drg_mortality",
    "num_emar_medications", "num_abnormal_labevents",
    "num_prev_emergency", "num_prev_non_emergency",
    "num_prev_general_practice", "num_prev_general_surgery", "num_prev_internal_medicine",
    "age", "charlson_comorbidity_index",
]

# Spark types of the feature table (the output contract).
MODEL_DATA_TYPES = {
    "subject_id": "bigint", "hadm_id": "bigint", "race": "string",
    "admittime": "timestamp_ntz", "dischtime": "timestamp_ntz", "hospital_expire_flag": "int",
    "readmission_flag": "int",
    "num_procedures": "bigint", "num_unique_procedures": "bigint", "num_unique_icd_codes": "bigint",
    "num_unique_drugs": "bigint", "num_prescribed_days": "bigint", "num_prescription_records": "bigint",
    "num_hospital_admissions": "bigint",
    "proc_icd_codes": "string", "diag_icd_codes": "string", "drg_concat": "string",
    "top_drg_code": "string", "top_drg_type": "string", "top_drg_severity": "int", "top_drg_mortality": "int",
    "num_emar_medications": "bigint", "num_abnormal_labevents": "bigint",
    "num_prev_emergency": "bigint", "num_prev_non_emergency": "bigint",
    "num_prev_general_practice": "bigint", "num_prev_general_surgery": "bigint",
    "num_prev_internal_medicine": "bigint",
    "age": "int", "charlson_comorbidity_index": "int",
}

# Name of the row-index column pandas writes in front of an exported frame.
CSV_INDEX_COLUMN = "Unnamed: 0"

# Columns removed before modelling: identifiers, times, free-text code sequences.
# drg_concat and top_drg_code are high-cardinality text with no numeric form and
# are removed as well (see README, "Training frame").
TRAINING_DROP = [
    "proc_icd_codes", "diag_icd_codes", "admittime", "dischtime", "subject_id", "hadm_id",
    "drg_concat", "top_drg_code",
]
LABEL = "readmission_flag"
CATEGORICAL = ["race", "top_drg_type"]
# The numeric columns that are features, by name: what a later step adds to a frame never becomes one.
NUMERIC_FEATURES = [c for c in MODEL_DATA_COLUMNS if c not in (*TRAINING_DROP, *CATEGORICAL, LABEL)]


@dataclass(frozen=True)
class CodeRule:
    category: str
    version: int
    prefix_len: int
    values: tuple[str, ...] = ()
    lo: str | None = None
    hi: str | None = None


def parse_rules(text: str = CHARLSON_RULES) -> list[CodeRule]:
    """Turn the rule text into CodeRule records (in listed order)."""
    rules: list[CodeRule] = []
    for line in text.strip().splitlines():
        category, version, *specs = line.split()
        for spec in specs:
            n, body = spec.split(":")
            if ".." in body:
                lo, hi = body.split("..")
                rules.append(CodeRule(category, int(version), int(n), lo=lo, hi=hi))
            else:
                rules.append(CodeRule(category, int(version), int(n), values=tuple(body.split(","))))
    return rules


def categories(text: str = CHARLSON_RULES) -> list[str]:
    seen: list[str] = []
    for rule in parse_rules(text):
        if rule.category not in seen:
            seen.append(rule.category)
    return seen
