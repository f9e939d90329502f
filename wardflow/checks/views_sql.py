"""SQL text of the derived test views (runs unchanged on DuckDB and Spark SQL).

Kept equal to ``wardflow.sources.synthetic`` by ``tests/test_views.py``.
"""

VIEWS = {
    "patients": """
select c_custkey as subject_id, cast(18 + c_custkey % 73 as int) as anchor_age, cast(1994 + c_custkey % 9 as int) as anchor_year
from customer where c_custkey % 101 <> 100
""",
    "admissions": """
select o_custkey as subject_id, o_orderkey as hadm_id,
  o_orderdate + (o_orderkey % 24) * interval '1' hour as admittime,
  o_orderdate + (o_orderkey % 24 + 24 * (1 + o_orderkey % 10) + o_orderkey % 7) * interval '1' hour as dischtime,
  case when o_orderkey % 50 = 0 then o_orderdate + (o_orderkey % 24 + 24 * (1 + o_orderkey % 10) + o_orderkey % 7) * interval '1' hour end as deathtime,
  case o_orderpriority when '1-URGENT' then 'EMERGENCY ROOM' when '2-HIGH' then 'INTERNAL TRANSFER TO OR FROM PSYCH'
       when '5-LOW' then null else 'PHYSICIAN REFERRAL' end as admission_location,
  c_mktsegment as race, case when o_orderkey % 50 = 0 then 1 else 0 end as hospital_expire_flag
from orders join customer on o_custkey = c_custkey
""",
    "diagnoses_icd": """
select o_custkey as subject_id, l_orderkey as hadm_id, l_linenumber as seq_num, icd_code, icd_version
from lineitem join orders on l_orderkey = o_orderkey join (values
 (0,9,'410'),(1,9,'428'),(2,9,'39891'),(3,9,'4254'),(4,9,'4259'),(5,9,'425'),(6,9,'440'),(7,9,'0930'),(8,9,'4431'),(9,9,'430'),
 (10,9,'36234'),(11,9,'290'),(12,9,'2941'),(13,9,'490'),(14,9,'505'),(15,9,'4168'),(16,9,'725'),(17,9,'4465'),(18,9,'531'),(19,9,'570'),
 (20,9,'0706'),(21,9,'07022'),(22,9,'2500'),(23,9,'2504'),(24,9,'342'),(25,9,'3341'),(26,9,'582'),(27,9,'5880'),(28,9,'5830'),(29,9,'40301'),
 (30,9,'140'),(31,9,'172'),(32,9,'1740'),(33,9,'2000'),(34,9,'2386'),(35,9,'4560'),(36,9,'5722'),(37,9,'196'),(38,9,'042'),(39,9,'V56'),
 (40,9,'V427'),(41,9,'7999'),(42,10,'I21'),(43,10,'I252'),(44,10,'I43'),(45,10,'I099'),(46,10,'I70'),(47,10,'I731'),(48,10,'G45'),(49,10,'I60'),
 (50,10,'H340'),(51,10,'F00'),(52,10,'F051'),(53,10,'J40'),(54,10,'I278'),(55,10,'M05'),(56,10,'M315'),(57,10,'K25'),(58,10,'B18'),(59,10,'K700'),
 (60,10,'E100'),(61,10,'E102'),(62,10,'G81'),(63,10,'G041'),(64,10,'N18'),(65,10,'I120'),(66,10,'C43'),(67,10,'C00'),(68,10,'C26'),(69,10,'I850'),
 (70,10,'C77'),(71,10,'B20'),(72,10,'B23'),(73,10,'Z999')) as seed(idx, icd_version, icd_code)
 on (l_partkey * 31 + l_suppkey) % 74 = idx
""",
    "procedures_icd": """
select o_custkey as subject_id, l_orderkey as hadm_id, cast(l_shipdate as date) as chartdate,
  case when l_partkey % 97 = 0 then null else concat('P', cast(l_partkey % 50 as string)) end as icd_code
from lineitem join orders on l_orderkey = o_orderkey
""",
    "prescriptions": """
select o_custkey as subject_id, l_orderkey as hadm_id, p_name as drug, l_shipdate as starttime,
  case when l_suppkey % 31 = 0 then null else l_shipdate + (l_linenumber * 20 - 30) * interval '1' hour end as stoptime
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
""",
    "drgcodes": """
select o_custkey as subject_id, l_orderkey as hadm_id, l_returnflag as drg_type, cast(l_partkey as string) as drg_code,
  case when l_returnflag = 'A' then null else cast(l_linenumber % 4 + 1 as int) end as drg_severity,
  case when l_returnflag = 'A' then null else cast(l_suppkey % 4 + 1 as int) end as drg_mortality
from lineitem join orders on l_orderkey = o_orderkey
""",
    "emar": """
select o_custkey as subject_id, o_orderkey as hadm_id,
  case when event_id % 13 = 0 then null else concat('med', cast(user_id % 20 as string)) end as medication,
  case event_type when 'purchase' then 'Administered' when 'click' then 'Administered' when 'view' then 'Not Given' else null end as event_txt
from events join orders on event_id - event_id % 5 = o_orderkey
""",
    "labevents": """
select event_id as labevent_id, o_custkey as subject_id, case when event_type = 'signup' then null else o_orderkey end as hadm_id,
  case when value > 5 then 'abnormal' end as flag
from events join orders on event_id - event_id % 5 = o_orderkey
""",
    "transfers": """
select o_custkey as subject_id, l_shipdate as intime,
  case l_linenumber when 1 then 'Med/Surg' when 2 then 'Surgery' when 3 then 'Medicine' when 4 then null else 'PACU' end as careunit
from lineitem join orders on l_orderkey = o_orderkey
""",
}


# Which views each view reads (all read base tables only).
ORDER = list(VIEWS)


def with_views(body: str, names: list[str] | None = None) -> str:
    """Prefix ``body`` with the derived views it mentions, as CTEs."""
    import re as _re

    used = [n for n in ORDER if names and n in names or (names is None and _re.search(rf"\b{n}\b", body))]
    if not used:
        return body
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n].strip()}\n)" for n in used)
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
