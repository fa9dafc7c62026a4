"""Reference SQL (DuckDB) for every registered query.

Written independently of the DataFrame code, from the operator semantics: the
raw tables come from the portable fixture definitions, then each stage is a
plain SQL CTE (windows and CASE chains where the semantics are sequential).
Every query is ``WITH <whole chain> SELECT ...``; DuckDB ignores the CTEs a
query does not reference. Doubles are rounded to six places like the Spark side.
"""

from __future__ import annotations

from trialguard import schemas
from trialguard import terminology as tm
from trialguard.operators import cleaning as C

ARMS = [a.arm for a in tm.ARMS]  # fixture arms in code order
CONTROL = tm.CONTROL_ARM
ACTIVES = [a for a in ARMS if a != CONTROL]
Z = tm.Z95


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ident(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)" if isinstance(x, float) else f"CAST({x} AS DOUBLE)"


def ISO(x: str) -> str:
    return (
        f"(CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND substr({x}, 1, 4) <> '0000' "
        f"THEN TRY_CAST({x} AS DATE) END)"
    )


def NUM(x: str) -> str:
    return (
        f"(CASE WHEN regexp_full_match({x}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
        f"AND isfinite(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END)"
    )


def TXT(d: str) -> str:
    return f"COALESCE(CAST({d} AS VARCHAR), '')"


def SDAY(d: str, ref: str) -> str:
    return f"CAST(CASE WHEN ({d} - {ref}) >= 0 THEN ({d} - {ref}) + 1 ELSE ({d} - {ref}) END AS INTEGER)"


def FMT(n: str, d: str) -> str:
    return f"(CASE WHEN {d} = 0 THEN '0' ELSE CAST(({n}) AS VARCHAR) || ' (' || printf('%.1f', CAST(100 * ({n}) AS DOUBLE) / {d}) || '%)' END)"


def IN(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def R(x: str) -> str:
    return f"round({x}, 6)"


SEX_MAP = "CASE upper({x}) " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in tm.SEX_SYNONYMS.items()) + " END"
YN_MAP = "CASE upper({x}) " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in tm.YN_SYNONYMS.items()) + " END"
ARMN = "CASE {x} WHEN 'PBO' THEN 0 WHEN 'DRGA50' THEN 1 WHEN 'DRGA100' THEN 2 END"

SUBJECT_BASE = """SELECT c_custkey AS k, CAST(101 + c_custkey % 6 AS VARCHAR(10)) AS site,
       concat(CAST(101 + c_custkey % 6 AS VARCHAR(10)), '-', lpad(CAST(c_custkey AS VARCHAR(20)), 6, '0')) AS subj,
       DATE '2025-01-06' + CAST(c_custkey * 37 % 260 AS INT) AS d0,
       c_custkey % 3 AS a, c_nationkey AS nk FROM customer"""

RAW_DM = """SELECT k * 2 + copy AS RECNO,
 CASE WHEN k % 97 = 1 THEN '' ELSE subj END AS SUBJID, site AS SITEID,
 CASE WHEN k % 89 = 5 THEN 'abc' WHEN k % 166 = 7 THEN '99999999999' WHEN k % 83 = 7 THEN '150' ELSE CAST(16 + k * 7 % 72 AS VARCHAR(10)) END AS AGE,
 CASE WHEN k % 79 = 11 THEN 'Q' WHEN k % 10 = 2 THEN 'Male' WHEN k % 10 = 3 THEN 'female' WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS SEX,
 CASE WHEN nk % 8 = 0 THEN 'martian' WHEN nk % 8 = 1 THEN '' WHEN nk % 8 IN (2,3) THEN 'ASIAN' WHEN nk % 8 IN (4,5) THEN 'White' ELSE 'BLACK OR AFRICAN AMERICAN' END AS RACE,
 CASE WHEN k % 67 = 13 THEN 'XXX' WHEN a = 0 THEN 'PBO' WHEN a = 1 THEN 'DRGA50' ELSE 'DRGA100' END AS ARMCD,
 CASE WHEN a = 0 THEN 'Placebo' WHEN a = 1 THEN 'Drug A 50 mg' ELSE 'Drug A 100 mg' END AS ARM,
 CASE WHEN k % 71 = 17 THEN '01/02/2025' ELSE CAST(d0 AS VARCHAR(10)) END AS TRTSDT,
 CASE WHEN k % 61 = 19 THEN '' WHEN k % 59 = 23 THEN '2024-01-01' ELSE CAST(d0 + CAST(40 + k % 44 AS INT) AS VARCHAR(10)) END AS TRTEDT,
 CASE WHEN k % 13 = 4 THEN 'ADVERSE EVENT' WHEN k % 101 = 29 THEN 'DEATH' ELSE '' END AS DCSREAS,
 CASE WHEN k % 101 = 29 THEN CAST(d0 + 45 AS VARCHAR(10)) ELSE '' END AS DTHDT
FROM (SELECT *, 0 AS copy FROM fx_b UNION ALL SELECT *, 1 AS copy FROM fx_b WHERE k % 50 = 3)"""

RAW_AE = """SELECT n AS RECNO,
 CASE WHEN n % 311 = 8 THEN '999-9999' ELSE subj END AS SUBJID,
 CASE WHEN n % 2 = 0 THEN '' ELSE concat('verbatim ', CAST(n % 19 AS VARCHAR(10))) END AS AETERM,
 concat('PT', lpad(CAST(CASE WHEN a > 0 AND n % 4 = 0 THEN 0 ELSE n % 19 END AS VARCHAR(10)), 2, '0')) AS AEDECOD,
 concat('SOC', CAST((CASE WHEN a > 0 AND n % 4 = 0 THEN 0 ELSE n % 19 END) % 6 AS VARCHAR(10))) AS AEBODSYS,
 CASE WHEN n % 41 = 7 THEN '2025-13-45' ELSE CAST(d0 + CAST(n % 150 - 15 AS INT) AS VARCHAR(10)) END AS AESTDT,
 CASE WHEN n % 11 = 0 THEN '' WHEN n % 43 = 1 THEN 'nope' WHEN n % 47 = 2 THEN '2020-01-01' ELSE CAST(d0 + CAST(n % 150 - 15 + n % 20 AS INT) AS VARCHAR(10)) END AS AEENDT,
 CASE WHEN n % 53 = 3 THEN '9' WHEN n % 53 = 4 THEN '' ELSE substr(op, 1, 1) END AS AETOXGR,
 CASE WHEN n % 7 = 0 THEN 'Mild' WHEN n % 61 = 5 THEN 'TERRIBLE' ELSE '' END AS AESEV,
 CASE WHEN n % 59 = 4 THEN 'maybe' WHEN os = 'F' THEN 'yes' WHEN os = 'O' THEN '0' ELSE 'N' END AS AESER,
 CASE WHEN n % 5 = 0 THEN 'NOT RELATED' WHEN n % 5 = 1 THEN 'UNLIKELY RELATED' WHEN n % 5 = 2 THEN 'POSSIBLY RELATED' WHEN n % 5 = 3 THEN 'PROBABLY RELATED' ELSE 'RELATED' END AS AEREL,
 CASE WHEN n % 37 = 9 THEN 'DRUG WITHDRAWN' ELSE 'DOSE NOT CHANGED' END AS AEACN,
 CASE WHEN n % 97 = 6 THEN 'FATAL' ELSE 'RECOVERED/RESOLVED' END AS AEOUT
FROM (SELECT o_orderkey AS n, o_orderstatus AS os, o_orderpriority AS op, fx_b.* FROM orders JOIN fx_b ON o_custkey = fx_b.k)"""

RAW_LB = """SELECT concat(lpad(CAST(lo AS VARCHAR(20)), 10, '0'), '-', CAST(v AS VARCHAR(2)), '-', lpad(CAST(p AS VARCHAR(20)), 10, '0'), '-', lpad(CAST(s AS VARCHAR(20)), 10, '0'), '-', lpad(CAST(px AS VARCHAR(20)), 12, '0')) AS RECNO,
 CASE WHEN p % 307 = 4 THEN '999-9999' ELSE subj END AS SUBJID,
 CASE WHEN p % 211 = 9 THEN 'x' ELSE CAST(v AS VARCHAR(2)) END AS VISITNUM,
 CASE WHEN v = 1 THEN 'SCREENING' WHEN v = 2 THEN 'DAY 1' ELSE concat('WEEK ', CAST(4 * (v - 2) AS VARCHAR(4))) END AS VISIT,
 CASE WHEN p % 199 = 3 THEN 'bad' ELSE CAST(d0 + CAST((v - 2) * 28 + p % 5 - 2 AS INT) AS VARCHAR(10)) END AS LBDT,
 CASE WHEN t = 0 THEN 'ALT' WHEN t = 1 THEN 'AST' WHEN t = 2 THEN 'BILI' WHEN t = 3 THEN 'CREAT' WHEN t = 4 THEN 'HGB' ELSE 'NEUT' END AS LBTESTCD,
 CASE WHEN t = 0 THEN 'Alanine Aminotransferase' WHEN t = 1 THEN 'Aspartate Aminotransferase' WHEN t = 2 THEN 'Bilirubin' WHEN t = 3 THEN 'Creatinine' WHEN t = 4 THEN 'Hemoglobin' ELSE '' END AS LBTEST,
 CASE WHEN p % 191 = 2 THEN '<5' WHEN v > 2 AND (p + s) % 29 = 7 THEN CAST(raw_v * 6 AS VARCHAR(10)) ELSE CAST(raw_v AS VARCHAR(10)) END AS LBORRES,
 CASE WHEN t IN (0, 1) THEN 'U/L' WHEN t IN (2, 3) THEN 'umol/L' WHEN t = 4 THEN 'g/L' ELSE '10^9/L' END AS LBORRESU,
 CASE WHEN p % 181 = 1 THEN '999' WHEN t = 0 THEN '7' WHEN t = 1 THEN '10' WHEN t = 2 THEN '3' WHEN t = 3 THEN '60' WHEN t = 4 THEN '120' ELSE '1.8' END AS LBORNRLO,
 CASE WHEN t = 0 THEN '56' WHEN t = 1 THEN '40' WHEN t = 2 THEN '21' WHEN t = 3 THEN '110' WHEN t = 4 THEN '170' ELSE '7.5' END AS LBORNRHI
FROM (SELECT *, CASE WHEN t = 0 THEN q + 8 WHEN t = 1 THEN q WHEN t = 2 THEN q % 24 + 1 WHEN t = 3 THEN q + 62 WHEN t = 4 THEN q + 122 ELSE q % 9 END AS raw_v
      FROM (SELECT l_orderkey AS lo, l_partkey AS p, l_suppkey AS s, l_linenumber AS v, CAST(l_quantity AS INT) AS q,
                   CAST(round(l_extendedprice * 100) AS BIGINT) AS px, l_partkey % 6 AS t, fx_b.*
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN fx_b ON o_custkey = fx_b.k))"""

RACE_IN = IN(tm.RACE_CT)

DM_CHAIN = f"""
dm_p AS (SELECT d.*,
   min(CASE WHEN SUBJID <> '' THEN RECNO END) OVER (PARTITION BY SUBJID) AS first_recno,
   {NUM('AGE')} AS p_age, {SEX_MAP.format(x='SEX')} AS p_sex,
   CASE WHEN upper(RACE) = '' THEN 'NOT REPORTED' ELSE upper(RACE) END AS p_race,
   {ISO('TRTSDT')} AS p_start, {ISO('TRTEDT')} AS p_end
 FROM raw_dm d),
dm_c AS (SELECT *,
   COALESCE(SUBJID = '', false) AS c1,
   COALESCE(SUBJID <> '' AND RECNO <> first_recno, false) AS c2,
   COALESCE(p_age IS NULL OR p_age < 0 OR p_age > 120, false) AS c3,
   COALESCE(TRY_CAST(trunc(p_age) AS INTEGER) < 18 OR TRY_CAST(trunc(p_age) AS INTEGER) > 85, false) AS c4,
   COALESCE(p_sex IS NOT NULL AND p_sex <> SEX, false) AS c5,
   COALESCE(p_sex IS NULL, false) AS c6,
   COALESCE(p_race NOT IN {RACE_IN}, false) AS c7,
   COALESCE(ARMCD NOT IN ('PBO', 'DRGA50', 'DRGA100'), false) AS c8,
   COALESCE(p_start IS NULL, false) AS c9,
   COALESCE(p_end IS NULL OR p_end < p_start, false) AS c10
 FROM dm_p),
dm_f AS (SELECT *,
   CASE WHEN c1 THEN 'missing SUBJID' WHEN c2 THEN 'duplicate SUBJID' WHEN c3 THEN 'invalid AGE' WHEN c6 THEN 'invalid SEX'
        WHEN c8 THEN 'invalid ARMCD' WHEN c9 THEN 'invalid TRTSDT' END AS QREASON,
   c1 AS h1, NOT c1 AND c2 AS h2, NOT (c1 OR c2) AND c3 AS h3, NOT (c1 OR c2 OR c3) AND c4 AS h4,
   NOT (c1 OR c2 OR c3) AND c5 AS h5, NOT (c1 OR c2 OR c3) AND c6 AS h6, NOT (c1 OR c2 OR c3 OR c6) AND c7 AS h7,
   NOT (c1 OR c2 OR c3 OR c6) AND c8 AS h8, NOT (c1 OR c2 OR c3 OR c6 OR c8) AND c9 AS h9,
   NOT (c1 OR c2 OR c3 OR c6 OR c8 OR c9) AND c10 AS h10
 FROM dm_c),
dm_clean AS (SELECT RECNO, SUBJID, 'SYN-SAFETY-001-' || SUBJID AS USUBJID, SITEID, TRY_CAST(trunc(p_age) AS INTEGER) AS AGE,
   p_sex AS SEX, CASE WHEN p_race IN {RACE_IN} THEN p_race ELSE 'UNKNOWN' END AS RACE, 'NOT REPORTED' AS ETHNIC, '' AS COUNTRY,
   ARMCD, ARM, p_start AS TRTSDT, CASE WHEN p_end IS NULL OR p_end < p_start THEN p_start ELSE p_end END AS TRTEDT,
   CAST(NULL AS DATE) AS RANDDT, {ISO('DTHDT')} AS DTHDT, DCSREAS
 FROM dm_f WHERE QREASON IS NULL),
dm_quarantine AS (SELECT RECNO, SUBJID, SITEID, AGE, SEX, RACE, ARMCD, ARM, TRTSDT, TRTEDT, DCSREAS, DTHDT,
   'NOT REPORTED' AS ETHNIC, '' AS COUNTRY, '' AS RANDDT, QREASON FROM dm_f WHERE QREASON IS NOT NULL),
dm_hits AS (
   SELECT 'DM-R01' AS key, CAST(NULL AS VARCHAR) AS id FROM dm_f WHERE h1
   UNION ALL SELECT 'DM-R02', SUBJID FROM dm_f WHERE h2 UNION ALL SELECT 'DM-R03', SUBJID FROM dm_f WHERE h3
   UNION ALL SELECT 'DM-R04', SUBJID FROM dm_f WHERE h4 UNION ALL SELECT 'DM-R05', SUBJID FROM dm_f WHERE h5
   UNION ALL SELECT 'DM-R06', SUBJID FROM dm_f WHERE h6 UNION ALL SELECT 'DM-R07', SUBJID FROM dm_f WHERE h7
   UNION ALL SELECT 'DM-R08', SUBJID FROM dm_f WHERE h8 UNION ALL SELECT 'DM-R09', SUBJID FROM dm_f WHERE h9
   UNION ALL SELECT 'DM-R10', SUBJID FROM dm_f WHERE h10)"""

GRADE = f"(CASE WHEN {NUM('AETOXGR')} IN (1, 2, 3, 4, 5) THEN CAST({NUM('AETOXGR')} AS INTEGER) END)"

AE_CHAIN = f"""
ae_p AS (SELECT a.*, (d.USUBJID IS NOT NULL) AS known, {ISO('a.AESTDT')} AS p_start, {ISO('a.AEENDT')} AS p_end,
   {GRADE} AS p_grade, {YN_MAP.format(x='a.AESER')} AS p_ser
 FROM (SELECT *, 'SYN-SAFETY-001-' || SUBJID AS USUBJID FROM raw_ae) a LEFT JOIN dm_clean d ON a.USUBJID = d.USUBJID),
ae_c AS (SELECT *, NOT known AS c1, p_start IS NULL AS c2, COALESCE(AEENDT <> '' AND p_end IS NULL, false) AS c3,
   COALESCE(p_end IS NOT NULL AND p_end < p_start, false) AS c4, p_grade IS NULL AS c5, p_ser IS NULL AS c6 FROM ae_p),
ae_f AS (SELECT *, CASE WHEN c1 THEN 'subject not in DM' WHEN c2 THEN 'invalid AESTDT' END AS QREASON,
   c1 AS h1, NOT c1 AND c2 AS h2, NOT (c1 OR c2) AND c3 AS h3, NOT (c1 OR c2) AND c4 AS h4,
   NOT (c1 OR c2) AND c5 AS h5, NOT (c1 OR c2) AND c6 AS h6 FROM ae_c),
ae_clean AS (SELECT RECNO, SUBJID, USUBJID, CASE WHEN AETERM = '' THEN AEDECOD ELSE AETERM END AS AETERM, AEDECOD, AEBODSYS,
   p_start AS AESTDT, CASE WHEN c4 THEN NULL ELSE p_end END AS AEENDT, p_grade AS AETOXGR, COALESCE(p_ser, 'N') AS AESER,
   CASE WHEN upper(AESEV) IN ('MILD', 'MODERATE', 'SEVERE') THEN upper(AESEV) WHEN p_grade = 1 THEN 'MILD'
        WHEN p_grade = 2 THEN 'MODERATE' WHEN p_grade IS NOT NULL THEN 'SEVERE' END AS AESEV,
   AEREL, AEACN, AEOUT FROM ae_f WHERE QREASON IS NULL),
ae_quarantine AS (SELECT RECNO, SUBJID, AETERM, AEDECOD, AEBODSYS, AESTDT, AEENDT, AETOXGR, AESEV, AESER, AEREL, AEACN, AEOUT, QREASON
   FROM ae_f WHERE QREASON IS NOT NULL),
ae_hits AS (
   SELECT 'AE-R01' AS key, SUBJID AS id FROM ae_f WHERE h1 UNION ALL SELECT 'AE-R02', SUBJID FROM ae_f WHERE h2
   UNION ALL SELECT 'AE-R03', SUBJID FROM ae_f WHERE h3 UNION ALL SELECT 'AE-R04', SUBJID FROM ae_f WHERE h4
   UNION ALL SELECT 'AE-R05', SUBJID FROM ae_f WHERE h5 UNION ALL SELECT 'AE-R06', SUBJID FROM ae_f WHERE h6)"""

LB_CHAIN = f"""
lb_p AS (SELECT l.*, (d.USUBJID IS NOT NULL) AS known, {ISO('l.LBDT')} AS p_lbdt, {NUM('l.VISITNUM')} AS p_visit,
   {NUM('l.LBORRES')} AS p_value, {NUM('l.LBORNRLO')} AS p_lo, {NUM('l.LBORNRHI')} AS p_hi
 FROM (SELECT *, 'SYN-SAFETY-001-' || SUBJID AS USUBJID FROM raw_lb) l LEFT JOIN dm_clean d ON l.USUBJID = d.USUBJID),
lb_c AS (SELECT *, NOT known AS c1, p_lbdt IS NULL AS c2, p_visit IS NULL AS c3, p_value IS NULL AS c4,
   COALESCE(p_lo IS NULL OR p_hi IS NULL OR p_lo >= p_hi, true) AS c5 FROM lb_p),
lb_f AS (SELECT *, CASE WHEN c1 THEN 'subject not in DM' WHEN c2 THEN 'invalid LBDT' WHEN c3 THEN 'invalid VISITNUM' END AS QREASON,
   c1 AS h1, NOT c1 AND c2 AS h2, NOT (c1 OR c2) AND c3 AS h3, NOT (c1 OR c2 OR c3) AND c4 AS h4,
   NOT (c1 OR c2 OR c3) AND c5 AS h5 FROM lb_c),
lb_clean AS (SELECT RECNO, SUBJID, USUBJID, p_visit AS VISITNUM, VISIT, p_lbdt AS LBDT, LBTESTCD, LBTEST, LBORRES, LBORRESU,
   p_value AS LBSTRESN, CASE WHEN c5 THEN NULL ELSE p_lo END AS LBORNRLO, CASE WHEN c5 THEN NULL ELSE p_hi END AS LBORNRHI
 FROM lb_f WHERE QREASON IS NULL),
lb_quarantine AS (SELECT RECNO, SUBJID, VISITNUM, VISIT, LBDT, LBTESTCD, LBTEST, LBORRES, LBORRESU, LBORNRLO, LBORNRHI, QREASON
   FROM lb_f WHERE QREASON IS NOT NULL),
lb_hits AS (
   SELECT 'LB-R01' AS key, SUBJID AS id FROM lb_f WHERE h1 UNION ALL SELECT 'LB-R02', SUBJID FROM lb_f WHERE h2
   UNION ALL SELECT 'LB-R03', SUBJID FROM lb_f WHERE h3 UNION ALL SELECT 'LB-R04', SUBJID FROM lb_f WHERE h4
   UNION ALL SELECT 'LB-R05', SUBJID FROM lb_f WHERE h5)"""

SDTM_CHAIN = f"""
sdtm_dm AS (SELECT 'SYN-SAFETY-001' AS STUDYID, 'DM' AS DOMAIN, USUBJID, SUBJID, {TXT('TRTSDT')} AS RFSTDTC, {TXT('TRTEDT')} AS RFENDTC,
   SITEID, AGE, 'YEARS' AS AGEU, SEX, RACE, CASE WHEN ETHNIC = '' THEN 'NOT REPORTED' ELSE ETHNIC END AS ETHNIC, ARMCD, ARM,
   ARMCD AS ACTARMCD, ARM AS ACTARM, COUNTRY, CASE WHEN DTHDT IS NOT NULL THEN 'Y' ELSE '' END AS DTHFL, {TXT('DTHDT')} AS DTHDTC
 FROM dm_clean),
sdtm_ae AS (SELECT 'SYN-SAFETY-001' AS STUDYID, 'AE' AS DOMAIN, a.USUBJID,
   CAST(row_number() OVER (PARTITION BY a.USUBJID ORDER BY a.AESTDT, a.AEDECOD, a.RECNO) AS INTEGER) AS AESEQ,
   a.AETERM, a.AEDECOD, a.AEBODSYS, a.AESEV, a.AESER, a.AEREL, a.AEACN, a.AEOUT, a.AETOXGR,
   {TXT('a.AESTDT')} AS AESTDTC, {TXT('a.AEENDT')} AS AEENDTC, {SDAY('a.AESTDT', 'd.TRTSDT')} AS AESTDY, {SDAY('a.AEENDT', 'd.TRTSDT')} AS AEENDY
 FROM ae_clean a LEFT JOIN dm_clean d ON a.USUBJID = d.USUBJID),
lb_j AS (SELECT l.*, d.TRTSDT AS ref, (l.LBSTRESN IS NOT NULL AND COALESCE(l.LBDT <= d.TRTSDT, false)) AS elig
 FROM lb_clean l LEFT JOIN dm_clean d ON l.USUBJID = d.USUBJID),
sdtm_lb AS (SELECT 'SYN-SAFETY-001' AS STUDYID, 'LB' AS DOMAIN, USUBJID,
   CAST(row_number() OVER (PARTITION BY USUBJID ORDER BY LBTESTCD, LBDT, VISITNUM, RECNO) AS INTEGER) AS LBSEQ,
   LBTESTCD, LBTEST, LBORRES, LBORRESU, LBORNRLO, LBORNRHI, LBSTRESN, LBORRESU AS LBSTRESU,
   CASE WHEN LBSTRESN IS NULL OR LBORNRLO IS NULL OR LBORNRHI IS NULL THEN '' WHEN LBSTRESN < LBORNRLO THEN 'LOW'
        WHEN LBSTRESN > LBORNRHI THEN 'HIGH' ELSE 'NORMAL' END AS LBNRIND,
   CASE WHEN elig AND row_number() OVER (PARTITION BY USUBJID, LBTESTCD, elig ORDER BY LBDT DESC, VISITNUM, RECNO) = 1 THEN 'Y' ELSE '' END AS LBBLFL,
   CAST(trunc(VISITNUM) AS INTEGER) AS VISITNUM, VISIT, {TXT('LBDT')} AS LBDTC, {SDAY('LBDT', 'ref')} AS LBDY
 FROM lb_j)"""

ADAM_CHAIN = f"""
adsl AS (SELECT 'SYN-SAFETY-001' AS STUDYID, USUBJID, SUBJID, SITEID, COUNTRY, AGE, 'YEARS' AS AGEU,
   CASE WHEN AGE >= 0 AND AGE < 45 THEN '<45' WHEN AGE >= 45 AND AGE < 65 THEN '45-64' WHEN AGE >= 65 AND AGE < 200 THEN '>=65' ELSE '' END AS AGEGR1,
   CASE WHEN AGE >= 0 AND AGE < 45 THEN 1 WHEN AGE >= 45 AND AGE < 65 THEN 2 WHEN AGE >= 65 AND AGE < 200 THEN 3 END AS AGEGR1N,
   SEX, RACE, CASE WHEN ETHNIC = '' THEN 'NOT REPORTED' ELSE ETHNIC END AS ETHNIC, ARMCD, ARM,
   ARM AS TRT01P, {ARMN.format(x='ARMCD')} AS TRT01PN, ARM AS TRT01A, {ARMN.format(x='ARMCD')} AS TRT01AN,
   TRTSDT, TRTEDT, CAST(TRTEDT - TRTSDT + 1 AS INTEGER) AS TRTDURD,
   CASE WHEN TRTSDT IS NOT NULL THEN 'Y' ELSE 'N' END AS SAFFL, CASE WHEN ARMCD <> '' THEN 'Y' ELSE 'N' END AS ITTFL,
   CASE WHEN COALESCE(DCSREAS, '') = '' THEN 'COMPLETED' ELSE 'DISCONTINUED' END AS EOSSTT, COALESCE(DCSREAS, '') AS DCSREAS,
   CASE WHEN DTHDT IS NOT NULL THEN 'Y' ELSE '' END AS DTHFL
 FROM dm_clean),
adae_j AS (SELECT a.*, s.SITEID, s.AGE, s.SEX, s.RACE, s.TRT01A AS TRTA, s.TRT01AN AS TRTAN, s.SAFFL, s.TRTSDT, s.TRTEDT,
   {ISO('a.AESTDTC')} AS ASTDT, {ISO('a.AEENDTC')} AS AENDT
 FROM sdtm_ae a JOIN adsl s ON a.USUBJID = s.USUBJID),
adae_t AS (SELECT *, CASE WHEN ASTDT >= TRTSDT AND ASTDT <= TRTEDT + 30 THEN 'Y' ELSE '' END AS TRTEMFL FROM adae_j),
adae AS (SELECT STUDYID, USUBJID, SITEID, AGE, SEX, RACE, TRTA, TRTAN, SAFFL, TRTSDT, TRTEDT, AESEQ, AETERM, AEDECOD, AEBODSYS,
   AESEV, AESER, AEREL, AEACN, AEOUT, AETOXGR, AETOXGR AS ATOXGR, ASTDT, AENDT, {SDAY('ASTDT', 'TRTSDT')} AS ASTDY, TRTEMFL,
   CASE WHEN TRTEMFL = 'Y' AND row_number() OVER (PARTITION BY USUBJID, TRTEMFL ORDER BY ASTDT, AESEQ) = 1 THEN 'Y' ELSE '' END AS AOCCFL,
   CASE WHEN TRTEMFL = 'Y' AND row_number() OVER (PARTITION BY USUBJID, AEBODSYS, TRTEMFL ORDER BY ASTDT, AESEQ) = 1 THEN 'Y' ELSE '' END AS AOCCSFL,
   CASE WHEN TRTEMFL = 'Y' AND row_number() OVER (PARTITION BY USUBJID, AEDECOD, TRTEMFL ORDER BY ASTDT, AESEQ) = 1 THEN 'Y' ELSE '' END AS AOCCPFL
 FROM adae_t),
adlb_j AS (SELECT l.*, s.TRT01A AS TRTA, s.TRT01AN AS TRTAN, s.SAFFL,
   max(CASE WHEN l.LBBLFL = 'Y' THEN l.LBSTRESN END) OVER (PARTITION BY l.USUBJID, l.LBTESTCD) AS base,
   max(CASE WHEN l.LBBLFL = 'Y' THEN l.LBNRIND END) OVER (PARTITION BY l.USUBJID, l.LBTESTCD) AS bnr
 FROM sdtm_lb l JOIN adsl s ON l.USUBJID = s.USUBJID),
adlb AS (SELECT STUDYID, USUBJID, TRTA, TRTAN, SAFFL, LBTESTCD AS PARAMCD,
   (CASE WHEN LBTEST = '' THEN LBTESTCD ELSE LBTEST END) || ' (' || LBSTRESU || ')' AS PARAM, VISIT AS AVISIT, VISITNUM AS AVISITN,
   {ISO('LBDTC')} AS ADT, LBDY AS ADY, LBSTRESN AS AVAL, base AS BASE, LBSTRESN - base AS CHG,
   CASE WHEN abs(base) > 0 THEN CAST(100 AS DOUBLE) * (LBSTRESN - base) / base END AS PCHG, LBORNRLO AS ANRLO, LBORNRHI AS ANRHI,
   LBNRIND AS ANRIND, COALESCE(bnr, '') AS BNRIND, LBBLFL AS ABLFL, CASE WHEN LBORNRHI > 0 THEN LBSTRESN / LBORNRHI END AS R2ANRHI
 FROM adlb_j),
nsaf AS (SELECT TRT01A AS arm, count(DISTINCT USUBJID) AS n FROM adsl WHERE SAFFL = 'Y' GROUP BY TRT01A),
ntot AS (SELECT count(DISTINCT USUBJID) AS n FROM adsl WHERE SAFFL = 'Y'),
te AS (SELECT * FROM adae WHERE TRTEMFL = 'Y' AND SAFFL = 'Y')"""


def N(arm: str) -> str:
    """Safety N of an arm (scalar subquery; 0 when absent)."""
    return f"COALESCE((SELECT n FROM nsaf WHERE arm = {q(arm)}), 0)"


NT = "(SELECT n FROM ntot)"

CHAIN = f"""WITH fx_b AS ({SUBJECT_BASE}),
raw_dm AS ({RAW_DM}),
raw_ae AS ({RAW_AE}),
raw_lb AS ({RAW_LB}),{DM_CHAIN},{AE_CHAIN},{LB_CHAIN},{SDTM_CHAIN},{ADAM_CHAIN}"""


def findings_sql(hits_cte: str, rules) -> str:
    """Findings from a hit CTE ``(key, id)``: count, first five sorted distinct ids, rule metadata."""
    meta = " UNION ALL ".join(
        f"SELECT {q(r.key)} AS key, {q(r.rule_id)} AS rule_id, {q(r.domain)} AS domain, {q(r.severity)} AS severity, {q(r.message)} AS message"
        for r in rules
    )
    return f"""SELECT m.rule_id, m.domain, m.severity, m.message, CAST(count(*) AS BIGINT) AS count,
   COALESCE(array_to_string(list_slice(list_sort(list_distinct(list(h.id) FILTER (WHERE h.id IS NOT NULL))), 1, 5), ', '), '') AS examples
 FROM {hits_cte} h JOIN ({meta}) m ON h.key = m.key
 GROUP BY m.rule_id, m.domain, m.severity, m.message"""


def _arm_cols(expr_of, with_total: str | None = None) -> str:
    cols = [f"{expr_of(a)} AS {ident(a)}" for a in ARMS]
    if with_total:
        cols.append(f"{with_total} AS {ident('Total')}")
    return ", ".join(cols)


def _k(arm: str, distinct: bool = False) -> str:
    inner = "DISTINCT USUBJID" if distinct else "*"
    return f"count({inner}) FILTER (WHERE TRTA = {q(arm)})"


# --- conformance on the clean SDTM -------------------------------------------------------------

_ISO_TXT = "regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"


def _dtc_bad(x: str) -> str:
    return f"({x} IS NULL OR ({x} <> '' AND NOT {_ISO_TXT.format(x=x)}))"


CONF_HITS = f"""conf_hits AS (
   SELECT 'SD0004:' || d || ':' || c AS key, id FROM (
      SELECT 'DM' AS d, 'STUDYID' AS c, USUBJID AS id FROM sdtm_dm WHERE STUDYID IS NULL OR STUDYID = ''
      UNION ALL SELECT 'DM', 'DOMAIN', USUBJID FROM sdtm_dm WHERE DOMAIN IS NULL OR DOMAIN = ''
      UNION ALL SELECT 'DM', 'USUBJID', USUBJID FROM sdtm_dm WHERE USUBJID IS NULL OR USUBJID = ''
      UNION ALL SELECT 'AE', 'STUDYID', USUBJID FROM sdtm_ae WHERE STUDYID IS NULL OR STUDYID = ''
      UNION ALL SELECT 'AE', 'DOMAIN', USUBJID FROM sdtm_ae WHERE DOMAIN IS NULL OR DOMAIN = ''
      UNION ALL SELECT 'AE', 'USUBJID', USUBJID FROM sdtm_ae WHERE USUBJID IS NULL OR USUBJID = ''
      UNION ALL SELECT 'LB', 'STUDYID', USUBJID FROM sdtm_lb WHERE STUDYID IS NULL OR STUDYID = ''
      UNION ALL SELECT 'LB', 'DOMAIN', USUBJID FROM sdtm_lb WHERE DOMAIN IS NULL OR DOMAIN = ''
      UNION ALL SELECT 'LB', 'USUBJID', USUBJID FROM sdtm_lb WHERE USUBJID IS NULL OR USUBJID = '')
   UNION ALL SELECT 'SD0005:AE', USUBJID FROM sdtm_ae WHERE USUBJID NOT IN (SELECT USUBJID FROM sdtm_dm) OR USUBJID IS NULL
   UNION ALL SELECT 'SD0005:LB', USUBJID FROM sdtm_lb WHERE USUBJID NOT IN (SELECT USUBJID FROM sdtm_dm) OR USUBJID IS NULL
   UNION ALL SELECT 'SD0006:AE', USUBJID FROM (SELECT USUBJID, row_number() OVER (PARTITION BY USUBJID, AESEQ) AS rn FROM sdtm_ae) WHERE rn > 1
   UNION ALL SELECT 'SD0006:LB', USUBJID FROM (SELECT USUBJID, row_number() OVER (PARTITION BY USUBJID, LBSEQ) AS rn FROM sdtm_lb) WHERE rn > 1
   UNION ALL SELECT 'SD0007:DM:RFSTDTC', USUBJID FROM sdtm_dm WHERE {_dtc_bad('RFSTDTC')}
   UNION ALL SELECT 'SD0007:DM:RFENDTC', USUBJID FROM sdtm_dm WHERE {_dtc_bad('RFENDTC')}
   UNION ALL SELECT 'SD0007:DM:DTHDTC', USUBJID FROM sdtm_dm WHERE {_dtc_bad('DTHDTC')}
   UNION ALL SELECT 'SD0007:AE:AESTDTC', USUBJID FROM sdtm_ae WHERE {_dtc_bad('AESTDTC')}
   UNION ALL SELECT 'SD0007:AE:AEENDTC', USUBJID FROM sdtm_ae WHERE {_dtc_bad('AEENDTC')}
   UNION ALL SELECT 'SD0007:LB:LBDTC', USUBJID FROM sdtm_lb WHERE {_dtc_bad('LBDTC')}
   UNION ALL SELECT 'SD0008:AE:AESTDY', USUBJID FROM sdtm_ae WHERE AESTDY = 0
   UNION ALL SELECT 'SD0008:AE:AEENDY', USUBJID FROM sdtm_ae WHERE AEENDY = 0
   UNION ALL SELECT 'SD0008:LB:LBDY', USUBJID FROM sdtm_lb WHERE LBDY = 0
   UNION ALL SELECT 'DM0001', USUBJID FROM (SELECT USUBJID, row_number() OVER (PARTITION BY USUBJID) AS rn FROM sdtm_dm) WHERE rn > 1
   UNION ALL SELECT 'DM0002', USUBJID FROM sdtm_dm WHERE SEX IS NULL OR SEX NOT IN {IN(tm.SEX_CT)}
   UNION ALL SELECT 'DM0003', USUBJID FROM sdtm_dm WHERE DTHFL = 'Y' AND DTHDTC = ''
   UNION ALL SELECT 'AE0001', USUBJID FROM sdtm_ae WHERE AESEV IS NULL OR AESEV NOT IN {IN(tm.AESEV_CT)}
   UNION ALL SELECT 'AE0002', USUBJID FROM sdtm_ae WHERE AESER IS NULL OR AESER NOT IN ('Y', 'N')
   UNION ALL SELECT 'AE0003', USUBJID FROM sdtm_ae WHERE {ISO('AEENDTC')} < {ISO('AESTDTC')}
   UNION ALL SELECT 'AE0004', USUBJID FROM sdtm_ae WHERE AEOUT = 'FATAL' AND (AESER IS NULL OR AESER <> 'Y')
   UNION ALL SELECT 'AE0005', USUBJID FROM sdtm_ae WHERE AETOXGR >= 3 AND AESEV = 'MILD'
   UNION ALL SELECT 'LB0001', USUBJID FROM sdtm_lb GROUP BY USUBJID HAVING count(*) FILTER (WHERE LBBLFL = 'Y') = 0
   UNION ALL SELECT 'LB0002', USUBJID FROM sdtm_lb WHERE LBNRIND IS NULL OR LBNRIND NOT IN ('LOW', 'NORMAL', 'HIGH', ''))"""


def _conformance_rules():
    from trialguard.operators.rules import Rule

    rs = []
    for d in ("DM", "AE", "LB"):
        for c in ("STUDYID", "DOMAIN", "USUBJID"):
            rs.append(Rule("SD0004", d, "ERROR", f"{c} is null", key=f"SD0004:{d}:{c}"))
    for d in ("AE", "LB"):
        rs.append(Rule("SD0005", d, "ERROR", "USUBJID not found in DM", key=f"SD0005:{d}"))
    rs.append(Rule("SD0006", "AE", "ERROR", "AESEQ not unique within subject", key="SD0006:AE"))
    rs.append(Rule("SD0006", "LB", "ERROR", "LBSEQ not unique within subject", key="SD0006:LB"))
    for d, c in (("DM", "RFSTDTC"), ("DM", "RFENDTC"), ("DM", "DTHDTC"), ("AE", "AESTDTC"), ("AE", "AEENDTC"), ("LB", "LBDTC")):
        rs.append(Rule("SD0007", d, "ERROR", f"{c} is not ISO 8601", key=f"SD0007:{d}:{c}"))
    for d, c in (("AE", "AESTDY"), ("AE", "AEENDY"), ("LB", "LBDY")):
        rs.append(Rule("SD0008", d, "ERROR", f"{c} equals 0 (SDTM study days have no day 0)", key=f"SD0008:{d}:{c}"))
    rs += [
        Rule("DM0001", "DM", "ERROR", "USUBJID not unique in DM"),
        Rule("DM0002", "DM", "ERROR", "SEX not in controlled terminology"),
        Rule("DM0003", "DM", "WARNING", "DTHFL is Y but DTHDTC is missing"),
        Rule("AE0001", "AE", "ERROR", "AESEV not in controlled terminology"),
        Rule("AE0002", "AE", "ERROR", "AESER not Y/N"),
        Rule("AE0003", "AE", "ERROR", "AEENDTC before AESTDTC"),
        Rule("AE0004", "AE", "WARNING", "Fatal outcome but AESER is not Y"),
        Rule("AE0005", "AE", "WARNING", "Grade >=3 reported as MILD"),
        Rule("LB0001", "LB", "WARNING", "Subject has no baseline lab record"),
        Rule("LB0002", "LB", "ERROR", "LBNRIND not in controlled terminology"),
    ]
    return rs


def _w(x: str, n: str) -> tuple[str, str]:
    """Wilson (lower, upper) for double expressions ``x``, ``n`` (NULL when n <= 0)."""
    zz = dbl(Z * Z)
    p = f"({x} / {n})"
    denom = f"(CAST(1 AS DOUBLE) + {zz} / {n})"
    centre = f"(({p} + {zz} / (CAST(2 AS DOUBLE) * {n})) / {denom})"
    half = f"({dbl(Z)} * sqrt({p} * (CAST(1 AS DOUBLE) - {p}) / {n} + {zz} / (CAST(4 AS DOUBLE) * {n} * {n})) / {denom})"
    return (
        f"(CASE WHEN {n} > 0 THEN greatest(CAST(0 AS DOUBLE), {centre} - {half}) END)",
        f"(CASE WHEN {n} > 0 THEN least(CAST(1 AS DOUBLE), {centre} + {half}) END)",
    )


def _risk_sql() -> str:
    per_pt = ", ".join(f"count(DISTINCT USUBJID) FILTER (WHERE TRTA = {q(a)}) AS k{i}" for i, a in enumerate(ARMS))
    ci = ARMS.index(CONTROL)
    rows = " UNION ALL ".join(
        f"SELECT PT, SOC, {q(a)} AS Arm, CAST(k{ARMS.index(a)} AS BIGINT) AS xa, CAST({N(a)} AS BIGINT) AS na, "
        f"CAST(k{ci} AS BIGINT) AS xc, CAST({N(CONTROL)} AS BIGINT) AS nc FROM rd_p"
        for a in ACTIVES
    )
    x1, n1, x2, n2 = dbl("xa"), dbl("na"), dbl("xc"), dbl("nc")
    l1, u1 = _w(x1, n1)
    l2, u2 = _w(x2, n2)
    p1, p2 = f"({x1} / {n1})", f"({x2} / {n2})"
    d = f"({p1} - {p2})"
    lower = f"({d} - sqrt(pow({p1} - {l1}, 2) + pow({u2} - {p2}, 2)))"
    upper = f"({d} + sqrt(pow({u1} - {p1}, 2) + pow({p2} - {l2}, 2)))"
    valid = "(na > 0 AND nc > 0)"
    return f""", rd_p AS (SELECT AEBODSYS AS SOC, AEDECOD AS PT, {per_pt} FROM te GROUP BY AEBODSYS, AEDECOD),
rd_r AS ({rows}),
risk AS (SELECT PT, SOC, Arm, xa AS n_active, na AS N_active_arm, xc AS n_control, nc AS N_control_arm,
   CASE WHEN na <> 0 THEN CAST(100 AS DOUBLE) * xa / na END AS Pct_active,
   CASE WHEN nc <> 0 THEN CAST(100 AS DOUBLE) * xc / nc END AS Pct_control,
   CASE WHEN {valid} THEN CAST(100 AS DOUBLE) * {d} END AS Diff,
   CASE WHEN {valid} THEN CAST(100 AS DOUBLE) * greatest(CAST(-1 AS DOUBLE), {lower}) END AS Lower,
   CASE WHEN {valid} THEN CAST(100 AS DOUBLE) * least(CAST(1 AS DOUBLE), {upper}) END AS Upper
 FROM rd_r)"""


RISK_SELECT = "SELECT PT, SOC, Arm, n_active, N_active_arm, n_control, N_control_arm, round(Pct_active, 6) AS Pct_active, round(Pct_control, 6) AS Pct_control, round(Diff, 6) AS Diff, round(Lower, 6) AS Lower, round(Upper, 6) AS Upper FROM risk"

SOC_PT = f""", soc_g AS (SELECT AEBODSYS AS SOC, '' AS PT, true AS is_soc, TRTA, USUBJID FROM te
               UNION SELECT AEBODSYS, AEDECOD, false, TRTA, USUBJID FROM te),
soc_c AS (SELECT SOC, PT, is_soc, {', '.join(f'{_k(a)} AS k{i}' for i, a in enumerate(ARMS))} FROM soc_g GROUP BY SOC, PT, is_soc),
soc_pt AS (SELECT SOC, PT, {', '.join(f'{FMT(f"k{i}", N(a))} AS {ident(a)}' for i, a in enumerate(ARMS))},
   {FMT(' + '.join(f'k{i}' for i in range(len(ARMS))), NT)} AS "Total", CAST({' + '.join(f'k{i}' for i in range(len(ARMS)))} AS BIGINT) AS _total FROM soc_c)"""

HYS = """, hys_w AS (SELECT USUBJID, TRTA, max(CASE WHEN PARAMCD = 'ALT' THEN R2ANRHI END) AS ALT,
      max(CASE WHEN PARAMCD = 'AST' THEN R2ANRHI END) AS AST, max(CASE WHEN PARAMCD = 'BILI' THEN R2ANRHI END) AS BILI
   FROM adlb WHERE ABLFL <> 'Y' AND COALESCE(ADY, 0) > 1 AND PARAMCD IN ('ALT', 'AST', 'BILI') GROUP BY USUBJID, TRTA),
hys AS (SELECT USUBJID, TRTA, greatest(ALT, AST) AS "Peak ALT/AST xULN", BILI AS "Peak bilirubin xULN",
      COALESCE(greatest(ALT, AST) >= 3.0 AND BILI >= 2.0, false) AS "Potential Hy's law"
   FROM hys_w WHERE ALT IS NOT NULL OR AST IS NOT NULL OR BILI IS NOT NULL)"""

HYS_SELECT = """SELECT USUBJID, TRTA, round("Peak ALT/AST xULN", 6) AS "Peak ALT/AST xULN", round("Peak bilirubin xULN", 6) AS "Peak bilirubin xULN", "Potential Hy's law" FROM hys"""

SHIFT = """, shift_w AS (SELECT PARAMCD, TRTA, USUBJID, BNRIND,
      max(CASE ANRIND WHEN 'NORMAL' THEN 1 WHEN 'LOW' THEN 2 WHEN 'HIGH' THEN 3 ELSE 0 END) AS rk
   FROM adlb WHERE ABLFL <> 'Y' AND COALESCE(ADY, 0) > 1 AND ANRIND <> '' AND BNRIND <> '' GROUP BY PARAMCD, TRTA, USUBJID, BNRIND),
shift AS (SELECT PARAMCD, TRTA, BNRIND, CASE rk WHEN 1 THEN 'NORMAL' WHEN 2 THEN 'LOW' WHEN 3 THEN 'HIGH' ELSE '' END AS "Worst post-baseline",
      CAST(count(DISTINCT USUBJID) AS BIGINT) AS "Subjects" FROM shift_w GROUP BY ALL)"""

MEAN_CHANGE = """, mchg AS (SELECT PARAMCD, PARAM, TRTA, AVISITN, AVISIT, CAST(count(CHG) AS BIGINT) AS n, avg(CHG) AS "Mean CHG",
      stddev_samp(CHG) / sqrt(CAST(count(CHG) AS DOUBLE)) AS "SE"
   FROM adlb WHERE ABLFL <> 'Y' AND CHG IS NOT NULL AND AVISITN > 1 GROUP BY PARAMCD, PARAM, TRTA, AVISITN, AVISIT)"""

OVERVIEW = f""", ov_s AS (SELECT TRTA, USUBJID, true AS c0, bool_or(AESER = 'Y') AS c1, bool_or(COALESCE(ATOXGR >= 3, false)) AS c2,
      bool_or(AEREL IN {IN(tm.RELATED_TERMS)}) AS c3, bool_or(AEACN = 'DRUG WITHDRAWN') AS c4, bool_or(AEOUT = 'FATAL') AS c5
   FROM te GROUP BY TRTA, USUBJID),
ov_cat AS (SELECT * FROM (VALUES {', '.join(f'({i}, {q(c)})' for i, c in enumerate(('Any TEAE', 'Any serious TEAE', 'Any grade >=3 TEAE', 'Any treatment-related TEAE', 'TEAE leading to treatment discontinuation', 'TEAE leading to death')))}) AS t(ord, Category)),
ov_l AS (SELECT 0 AS ord, TRTA, USUBJID FROM ov_s WHERE c0 UNION ALL SELECT 1, TRTA, USUBJID FROM ov_s WHERE c1
   UNION ALL SELECT 2, TRTA, USUBJID FROM ov_s WHERE c2 UNION ALL SELECT 3, TRTA, USUBJID FROM ov_s WHERE c3
   UNION ALL SELECT 4, TRTA, USUBJID FROM ov_s WHERE c4 UNION ALL SELECT 5, TRTA, USUBJID FROM ov_s WHERE c5),
ov_k AS (SELECT c.ord, c.Category, {', '.join(f'CAST(count(l.USUBJID) FILTER (WHERE l.TRTA = {q(a)}) AS BIGINT) AS k{i}' for i, a in enumerate(ARMS))}
   FROM ov_cat c LEFT JOIN ov_l l ON c.ord = l.ord GROUP BY c.ord, c.Category),
overview AS (SELECT Category, {', '.join(f'{FMT(f"k{i}", N(a))} AS {ident(a)}' for i, a in enumerate(ARMS))},
   {FMT(' + '.join(f'k{i}' for i in range(len(ARMS))), NT)} AS "Total",
   {', '.join(f'k{i} AS {ident("_n_" + a)}' for i, a in enumerate(ARMS))}, CAST({' + '.join(f'k{i}' for i in range(len(ARMS)))} AS BIGINT) AS "_n_Total"
   FROM ov_k)"""


def _demographics() -> str:
    saf = "(SELECT * FROM adsl WHERE SAFFL = 'Y')"
    cols_all = ARMS + ["Total"]

    def where(c):
        return "true" if c == "Total" else f"TRT01A = {q(c)}"

    def stat(expr, c):
        return f"(SELECT {expr} FROM {saf} WHERE {where(c)})"

    n_row = ", ".join(f"CAST({stat('count(DISTINCT USUBJID)', c)} AS VARCHAR) AS {ident(c)}" for c in cols_all)
    mean_expr = "COALESCE(printf('%.1f', avg(AGE)), 'nan') || ' (' || COALESCE(printf('%.1f', stddev_samp(AGE)), 'nan') || ')'"
    med_expr = (
        "COALESCE(printf('%.0f', median(CAST(AGE AS DOUBLE))), 'nan') || ' (' || COALESCE(CAST(min(AGE) AS VARCHAR), 'nan')"
        " || '-' || COALESCE(CAST(max(AGE) AS VARCHAR), 'nan') || ')'"
    )
    mean_row = ", ".join(f"{stat(mean_expr, c)} AS {ident(c)}" for c in cols_all)
    med_row = ", ".join(f"{stat(med_expr, c)} AS {ident(c)}" for c in cols_all)
    lev_k = ", ".join(f"count(*) FILTER (WHERE TRT01A = {q(a)}) AS k{i}" for i, a in enumerate(ARMS))
    lev = f"""(SELECT var, level, {lev_k} FROM (
        SELECT 'Age group' AS var, AGEGR1 AS level, TRT01A FROM {saf}
        UNION ALL SELECT 'Sex', SEX, TRT01A FROM {saf}
        UNION ALL SELECT 'Race', RACE, TRT01A FROM {saf}) GROUP BY var, level)"""
    lev_cols = ", ".join(f"{FMT(f'k{i}', N(a))} AS {ident(a)}" for i, a in enumerate(ARMS))
    lev_total = FMT(" + ".join(f"k{i}" for i in range(len(ARMS))), NT)
    return f"""SELECT 'N' AS "Characteristic", {n_row}
UNION ALL SELECT 'Age, mean (SD)', {mean_row}
UNION ALL SELECT 'Age, median (min-max)', {med_row}
UNION ALL SELECT var || ': ' || level, {lev_cols}, {lev_total} FROM {lev}"""


def _broken_sql(w: str) -> str:
    """The domains with faults and the findings on them; the structural ones are plain rows."""
    n, s, x = "TRY_CAST(right(USUBJID, 6) AS INTEGER)", "(TRY_CAST(right(USUBJID, 6) AS INTEGER) + AESEQ)", "(TRY_CAST(right(USUBJID, 6) AS INTEGER) + LBSEQ)"
    orphan = "'SYN-SAFETY-001-999-000000'"

    def put(table: str, **faults: str) -> str:
        return f"SELECT * REPLACE ({', '.join(f'CASE WHEN {cond} THEN {value} ELSE {c} END AS {c}' for c, (cond, value) in faults.items())}) FROM {table}"

    dm = put(
        f"(SELECT * FROM sdtm_dm UNION ALL SELECT * FROM sdtm_dm WHERE {n} % 13 = 2)", STUDYID=(f"{n} % 11 = 1", "''"),
        SEX=(f"{n} % 17 = 3", "'X'"), DTHFL=(f"{n} % 19 = 4", "'Y'"), DTHDTC=(f"{n} % 19 = 4", "''"), RFENDTC=(f"{n} % 23 = 5", "'2025/01/01'"),
    )
    ae = put(
        "sdtm_ae", USUBJID=(f"{s} % 29 = 6", orphan), AESEQ=(f"{n} % 7 = 0 AND AESEQ = 2", "1"), AESTDTC=(f"{s} % 31 = 7", "'bad'"),
        AESTDY=(f"{s} % 37 = 8", "0"), AESEV=(f"{s} % 41 = 9", f"CASE WHEN {s} % 2 = 0 THEN 'AWFUL' ELSE 'MILD' END"), AESER=(f"{s} % 43 = 10", "'U'"),
        AEENDTC=(f"{s} % 47 = 11", "'1999-01-01'"), AEOUT=(f"{s} % 43 = 10", "'FATAL'"), AETOXGR=(f"{s} % 41 = 9", "4"), DOMAIN=(f"{s} % 53 = 12", "NULL"),
    )
    lb = put(
        "sdtm_lb", USUBJID=(f"{x} % 61 = 13", orphan), LBSEQ=(f"{n} % 5 = 0 AND LBSEQ = 3", "1"), LBBLFL=(f"{n} % 6 = 1", "''"),
        LBNRIND=(f"{x} % 67 = 14", "'ODD'"), LBDY=(f"{x} % 71 = 15", "0"), LBDTC=(f"{x} % 73 = 16", "'2025-13-01'"),
    )
    hits = CONF_HITS
    for d in ("dm", "ae", "lb"):
        hits = hits.replace(f"sdtm_{d}", f"broken_{d}")
    structural = """ UNION ALL SELECT 'SD0001', 'DM', 'ERROR', 'Required variables missing: COUNTRY', 1, ''
        UNION ALL SELECT 'SD0002', 'DM', 'ERROR', 'Variable name longer than 8 characters', 1, 'LONGVARNAME'
        UNION ALL SELECT 'SD0003', 'DM', 'ERROR', 'Variable label longer than 40 characters', 1, 'XLABEL'"""
    return f"{w}, broken_dm AS ({dm}), broken_ae AS ({ae}), broken_lb AS ({lb}), {hits} {findings_sql('conf_hits', _conformance_rules())}{structural}"


def _digest_sql(w: str) -> str:
    """Row counts and content digests of the datasets."""
    parts = []
    for name, table in (("DM", "sdtm_dm"), ("AE", "sdtm_ae"), ("LB", "sdtm_lb"), ("ADSL", "adsl"), ("ADAE", "adae"), ("ADLB", "adlb")):
        texts = []
        for column, kind in schemas.SPECS[name]:
            if kind == schemas.D:
                text = f"CAST(CAST(floor({column} * 1e6 + 0.5) AS BIGINT) AS VARCHAR) || ';'"
            elif kind.typeName() == "string":
                text = f"'V' || length({column}) || ':' || {column}"
            else:
                text = f"CAST({column} AS VARCHAR) || ';'"
            texts.append(f"coalesce({text}, 'N')")
        bits = f"CAST('0x' || substr(sha256({' || '.join(texts)}), 1, 15) AS BIGINT)"
        parts.append(f"SELECT '{name}' AS dataset, CAST(count(*) AS BIGINT) AS records, CAST(coalesce(sum({bits}), 0) AS VARCHAR) AS digest FROM {table}")
    return f"{w} " + " UNION ALL ".join(parts)


def queries() -> dict[str, str]:
    w = CHAIN
    dm_rules, ae_rules, lb_rules = C.DM_RULES, C.AE_RULES, C.LB_RULES
    conf = f"{w},{CONF_HITS}\n"
    all_findings = (
        f"{findings_sql('dm_hits', dm_rules)} UNION ALL {findings_sql('ae_hits', ae_rules)} UNION ALL "
        f"{findings_sql('lb_hits', lb_rules)} UNION ALL {findings_sql('conf_hits', _conformance_rules())}"
    )
    preview_cols = "STUDYID, USUBJID, SITEID, AGE, SEX, RACE, TRTA, TRTAN, SAFFL, TRTSDT, TRTEDT, AESEQ, AETERM, AEDECOD, AEBODSYS, AESEV, AESER, AEREL, AEACN, AEOUT, AETOXGR, ATOXGR, ASTDT, AENDT, ASTDY, TRTEMFL, AOCCFL, AOCCSFL, AOCCPFL"
    lab_cols_r = "STUDYID, USUBJID, TRTA, TRTAN, SAFFL, PARAMCD, PARAM, AVISIT, AVISITN, ADT, ADY, round(AVAL, 6) AS AVAL, round(BASE, 6) AS BASE, round(CHG, 6) AS CHG, round(PCHG, 6) AS PCHG, round(ANRLO, 6) AS ANRLO, round(ANRHI, 6) AS ANRHI, ANRIND, BNRIND, ABLFL, round(R2ANRHI, 6) AS R2ANRHI"
    sdtm_lb_r = "STUDYID, DOMAIN, USUBJID, LBSEQ, LBTESTCD, LBTEST, LBORRES, LBORRESU, round(LBORNRLO, 6) AS LBORNRLO, round(LBORNRHI, 6) AS LBORNRHI, round(LBSTRESN, 6) AS LBSTRESN, LBSTRESU, LBNRIND, LBBLFL, VISITNUM, VISIT, LBDTC, LBDY"
    lb_clean_r = "RECNO, SUBJID, USUBJID, round(VISITNUM, 6) AS VISITNUM, VISIT, LBDT, LBTESTCD, LBTEST, LBORRES, LBORRESU, round(LBSTRESN, 6) AS LBSTRESN, round(LBORNRLO, 6) AS LBORNRLO, round(LBORNRHI, 6) AS LBORNRHI"
    top = f"""{w}, pti AS (SELECT AEDECOD, TRTA, CAST(count(DISTINCT USUBJID) AS BIGINT) AS "Subjects" FROM adae WHERE TRTEMFL = 'Y' GROUP BY AEDECOD, TRTA),
pti_top AS (SELECT AEDECOD FROM pti GROUP BY AEDECOD ORDER BY sum("Subjects") DESC, AEDECOD LIMIT 12)
SELECT p.AEDECOD, p.TRTA, p."Subjects", round(CASE WHEN s.n > 0 THEN CAST(100 AS DOUBLE) * p."Subjects" / s.n END, 6) AS "Percent"
FROM pti p LEFT JOIN nsaf s ON p.TRTA = s.arm WHERE p.AEDECOD IN (SELECT AEDECOD FROM pti_top)"""
    forest_arm = sorted(ACTIVES)[-1]
    search = "soc0|pt1"
    soc_cols = ", ".join(ident(a) for a in ARMS + ["Total"])
    return {
        "raw_dm": f"{w} SELECT * FROM raw_dm",
        "raw_ae": f"{w} SELECT * FROM raw_ae",
        "raw_lb": f"{w} SELECT * FROM raw_lb",
        # values as they were before they were written; what is missing is empty text
        "read_csv_dm": f"""{w} SELECT CAST(RECNO AS VARCHAR) AS ROW, SUBJID, SITEID, AGE, SEX,
 CASE RECNO % 7 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'NA' ELSE RACE END AS RACE, ARMCD, ARM, TRTSDT, TRTEDT, DCSREAS, DTHDT,
 CASE WHEN RECNO % 5 = 0 THEN 'Côte d''Ivoire; est' ELSE '' END AS COUNTRY FROM raw_dm""",
        "read_csv_lb": f"""{w} SELECT * REPLACE (concat('a "quoted", té', LBTESTCD) AS LBTEST, CASE WHEN LBTESTCD = 'ALT' THEN '' ELSE '"' END AS LBORRESU)
 RENAME (RECNO AS ROW) FROM raw_lb""",
        "read_parquet_ae": f"""{w} SELECT * REPLACE (coalesce(CAST(TRY_CAST(AETOXGR AS INTEGER) AS VARCHAR), '') AS AETOXGR,
 coalesce(CAST(TRY_CAST(AESTDT AS DATE) AS VARCHAR), '') AS AESTDT, CASE AESER WHEN 'yes' THEN 'true' WHEN 'N' THEN 'false' ELSE '' END AS AESER)
 RENAME (RECNO AS ROW) FROM raw_ae""",
        "normalized_dm": f"{w} SELECT RECNO, "
        + ", ".join(
            f"CASE WHEN trim({c}) IN ('nan', 'None', 'NaT', '<NA>') THEN '' ELSE trim({c}) END AS {c}"
            for c in ("SUBJID", "SITEID", "AGE", "SEX", "RACE", "ARMCD", "ARM", "TRTSDT", "TRTEDT", "DCSREAS", "DTHDT")
        )
        + " FROM raw_dm",
        "expr_dates": f"{w} SELECT RECNO, AESTDT AS start_text, AEENDT AS end_text, {ISO('AESTDT')} AS start_date, {ISO('AEENDT')} AS end_date FROM raw_ae",
        "expr_numbers": f"{w} SELECT RECNO, LBORRES, round({NUM('LBORRES')}, 6) AS result_num, LBORNRLO, round({NUM('LBORNRLO')}, 6) AS low_num, VISITNUM, round({NUM('VISITNUM')}, 6) AS visit_num FROM raw_lb",
        "dm_clean": f"{w} SELECT * FROM dm_clean",
        "ae_clean": f"{w} SELECT * FROM ae_clean",
        "lb_clean": f"{w} SELECT {lb_clean_r} FROM lb_clean",
        "dm_quarantine": f"{w} SELECT * FROM dm_quarantine",
        "ae_quarantine": f"{w} SELECT * FROM ae_quarantine",
        "lb_quarantine": f"{w} SELECT * FROM lb_quarantine",
        "dm_findings": f"{w} {findings_sql('dm_hits', dm_rules)}",
        "ae_findings": f"{w} {findings_sql('ae_hits', ae_rules)}",
        "lb_findings": f"{w} {findings_sql('lb_hits', lb_rules)}",
        "ae_orphans": f"{w} SELECT RECNO, SUBJID FROM raw_ae WHERE 'SYN-SAFETY-001-' || SUBJID NOT IN (SELECT USUBJID FROM dm_clean)",
        "sdtm_dm": f"{w} SELECT * FROM sdtm_dm",
        "sdtm_ae": f"{w} SELECT * FROM sdtm_ae",
        "sdtm_lb": f"{w} SELECT {sdtm_lb_r} FROM sdtm_lb",
        "adsl": f"{w} SELECT * FROM adsl",
        "adae": f"{w} SELECT * FROM adae",
        "adlb": f"{w} SELECT {lab_cols_r} FROM adlb",
        "conformance": f"{conf} {findings_sql('conf_hits', _conformance_rules())}",
        "conformance_broken": _broken_sql(w),
        "content_digest": _digest_sql(w),
        "conformance_orphans": f"""{w} SELECT domain, USUBJID, CAST(count(*) AS BIGINT) AS records FROM (
            SELECT 'AE' AS domain, 'SYN-SAFETY-001-' || SUBJID AS USUBJID FROM raw_ae UNION ALL
            SELECT 'LB', 'SYN-SAFETY-001-' || SUBJID FROM raw_lb) WHERE USUBJID NOT IN (SELECT USUBJID FROM sdtm_dm) GROUP BY domain, USUBJID""",
        "labs_without_baseline": f"{w} SELECT USUBJID FROM sdtm_lb GROUP BY USUBJID HAVING count(*) FILTER (WHERE LBBLFL = 'Y') = 0",
        "arm_order": f"{w} SELECT TRT01A, arg_min(TRT01AN, USUBJID) AS TRT01AN FROM adsl GROUP BY TRT01A",
        "safety_n": f"""{w} SELECT TRT01A AS "Arm", CAST(count(DISTINCT CASE WHEN SAFFL = 'Y' THEN USUBJID END) AS BIGINT) AS "N" FROM adsl GROUP BY TRT01A
            UNION ALL SELECT 'Total', CAST(count(DISTINCT USUBJID) AS BIGINT) FROM adsl WHERE SAFFL = 'Y'""",
        "demographics": f"{w} {_demographics()}",
        "teae_overview": f"{w}{OVERVIEW} SELECT * FROM overview",
        "teae_soc_pt": f"{w}{SOC_PT} SELECT * FROM soc_pt",
        "risk_differences": f"{w}{_risk_sql()} {RISK_SELECT}",
        "wilson_by_pt": _wilson_by_pt(w),
        "lab_shift": f"{w}{SHIFT} SELECT * FROM shift",
        "hys_law": f"{w}{HYS} {HYS_SELECT}",
        "lab_mean_change": f"""{w}{MEAN_CHANGE} SELECT PARAMCD, PARAM, TRTA, AVISITN, AVISIT, n, round("Mean CHG", 6) AS "Mean CHG", round("SE", 6) AS "SE" FROM mchg""",
        "findings": f"{conf} {all_findings}",
        "findings_by_severity": f"{conf} SELECT severity, CAST(count(*) AS BIGINT) AS findings FROM ({all_findings}) GROUP BY severity",
        "run_status": f"""{conf}, fnd AS ({all_findings}),
            qn AS (SELECT (SELECT count(*) FROM dm_quarantine) + (SELECT count(*) FROM ae_quarantine) + (SELECT count(*) FROM lb_quarantine) AS q)
            SELECT CASE WHEN e > 0 OR wn > 0 OR q > 0 THEN {q(tm.STATUS_WARN)} ELSE {q(tm.STATUS_PASSED)} END AS status,
                   CAST(e AS BIGINT) AS errors, CAST(wn AS BIGINT) AS warnings, CAST(nn AS BIGINT) AS notes, CAST(q AS BIGINT) AS quarantined
            FROM (SELECT count(*) FILTER (WHERE severity = 'ERROR') AS e, count(*) FILTER (WHERE severity = 'WARNING') AS wn,
                         count(*) FILTER (WHERE severity = 'NOTE') AS nn FROM fnd), qn""",
        "record_counts": f"""{w} SELECT 'DM' AS dataset, CAST(count(*) AS BIGINT) AS records FROM sdtm_dm
            UNION ALL SELECT 'AE', count(*) FROM sdtm_ae UNION ALL SELECT 'LB', count(*) FROM sdtm_lb
            UNION ALL SELECT 'ADSL', count(*) FROM adsl UNION ALL SELECT 'ADAE', count(*) FROM adae UNION ALL SELECT 'ADLB', count(*) FROM adlb
            UNION ALL SELECT 'quarantine_dm', count(*) FROM dm_quarantine UNION ALL SELECT 'quarantine_ae', count(*) FROM ae_quarantine
            UNION ALL SELECT 'quarantine_lb', count(*) FROM lb_quarantine""",
        "xpt_ready_adsl": f"""{w} SELECT STUDYID, USUBJID, SUBJID, SITEID, COUNTRY, CAST(AGE AS DOUBLE) AS AGE, AGEU, AGEGR1, CAST(AGEGR1N AS DOUBLE) AS AGEGR1N,
            SEX, RACE, ETHNIC, ARMCD, ARM, TRT01P, CAST(TRT01PN AS DOUBLE) AS TRT01PN, TRT01A, CAST(TRT01AN AS DOUBLE) AS TRT01AN,
            CAST(TRTSDT - DATE '1960-01-01' AS DOUBLE) AS TRTSDT, CAST(TRTEDT - DATE '1960-01-01' AS DOUBLE) AS TRTEDT,
            CAST(TRTDURD AS DOUBLE) AS TRTDURD, SAFFL, ITTFL, EOSSTT, DCSREAS, DTHFL FROM adsl""",
        "dataset_metadata": _metadata_sql(w),
        "dashboard_kpis": f"""{w}{OVERVIEW}{HYS} SELECT CAST(s AS BIGINT) AS safety_population, round(CASE WHEN s > 0 THEN CAST(100 AS DOUBLE) * a / s END, 6) AS any_teae_pct,
            CAST(ser AS BIGINT) AS serious_teae, CAST(g3 AS BIGINT) AS grade3_teae, CAST(d AS BIGINT) AS deaths, CAST(h AS BIGINT) AS potential_hys_law FROM (
            SELECT (SELECT count(*) FROM adsl WHERE SAFFL = 'Y') AS s,
                   (SELECT "_n_Total" FROM overview WHERE Category = 'Any TEAE') AS a,
                   (SELECT "_n_Total" FROM overview WHERE Category = 'Any serious TEAE') AS ser,
                   (SELECT "_n_Total" FROM overview WHERE Category = 'Any grade >=3 TEAE') AS g3,
                   (SELECT "_n_Total" FROM overview WHERE Category = 'TEAE leading to death') AS d,
                   (SELECT count(*) FROM hys WHERE "Potential Hy's law") AS h)""",
        "pt_incidence_top": top,
        "forest_rows": f"{w}{_risk_sql()} {RISK_SELECT} WHERE Arm = {q(forest_arm)} AND n_active + n_control >= 3",
        "soc_pt_search": f"""{w}{SOC_PT} SELECT SOC, CASE WHEN PT = '' THEN {q('— any term in SOC —')} ELSE PT END AS PT, {soc_cols} FROM soc_pt
            WHERE regexp_matches(SOC, {q(search)}, 'i') OR regexp_matches(PT, {q(search)}, 'i')""",
        "edish_points": f"""{w}{HYS} {HYS_SELECT} WHERE "Peak ALT/AST xULN" IS NOT NULL AND "Peak bilirubin xULN" IS NOT NULL""",
        "mean_change_band": f"""{w}{MEAN_CHANGE} SELECT PARAMCD, PARAM, TRTA, AVISITN, AVISIT, n, round("Mean CHG", 6) AS "Mean CHG", round("SE", 6) AS "SE",
            round("Mean CHG" - CAST(1.96 AS DOUBLE) * "SE", 6) AS lo, round("Mean CHG" + CAST(1.96 AS DOUBLE) * "SE", 6) AS hi FROM mchg""",
        "lab_shift_wide": f"""{w}{SHIFT} SELECT PARAMCD, TRTA, BNRIND,
            CAST(COALESCE(sum("Subjects") FILTER (WHERE "Worst post-baseline" = 'HIGH'), 0) AS BIGINT) AS "HIGH",
            CAST(COALESCE(sum("Subjects") FILTER (WHERE "Worst post-baseline" = 'LOW'), 0) AS BIGINT) AS "LOW",
            CAST(COALESCE(sum("Subjects") FILTER (WHERE "Worst post-baseline" = 'NORMAL'), 0) AS BIGINT) AS "NORMAL"
            FROM shift GROUP BY PARAMCD, TRTA, BNRIND""",
        "dataset_preview": f"{w} SELECT {preview_cols} FROM adae ORDER BY USUBJID, AESEQ LIMIT 500",
    }


def _wilson_by_pt(w: str) -> str:
    per = ", ".join(f"count(DISTINCT USUBJID) FILTER (WHERE TRTA = {q(a)}) AS k{i}" for i, a in enumerate(ARMS))
    rows = " UNION ALL ".join(f"SELECT PT, {q(a)} AS Arm, CAST(k{i} AS BIGINT) AS x, CAST({N(a)} AS BIGINT) AS n FROM wp" for i, a in enumerate(ARMS))
    lo, hi = _w(dbl("x"), dbl("n"))
    return f"""{w}, wp AS (SELECT AEDECOD AS PT, {per} FROM te GROUP BY AEDECOD), wr AS ({rows})
SELECT PT, Arm, x, n, round({lo}, 6) AS "Lower", round({hi}, 6) AS "Upper" FROM wr"""


def _metadata_sql(w: str) -> str:

    rows = []
    for name in ("DM", "AE", "LB", "ADSL", "ADAE", "ADLB"):
        for pos, (var, typ) in enumerate(schemas.SPECS[name], start=1):
            num = typ.typeName() in ("integer", "double", "date", "long", "boolean")
            rows.append(
                f"({q(name)}, {q(tm.DATASET_LABELS[name])}, {pos}, {q(var)}, {q(tm.LABELS.get(var, ''))}, {q('Num' if num else 'Char')})"
            )
    counts = {"DM": "sdtm_dm", "AE": "sdtm_ae", "LB": "sdtm_lb", "ADSL": "adsl", "ADAE": "adae", "ADLB": "adlb"}
    cnt = " UNION ALL ".join(f"SELECT {q(k)} AS dataset, CAST(count(*) AS BIGINT) AS records FROM {v}" for k, v in counts.items())
    return f"""{w}, meta AS (SELECT * FROM (VALUES {', '.join(rows)}) AS t(dataset, label, position, variable, variable_label, type)), cnt AS ({cnt})
SELECT m.dataset, m.label, c.records, CAST(m.position AS INTEGER) AS position, m.variable, m.variable_label, m.type FROM meta m LEFT JOIN cnt c ON m.dataset = c.dataset"""
