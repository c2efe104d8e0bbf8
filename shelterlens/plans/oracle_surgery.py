"""DuckDB oracle SQL for the surgery queries: per-month pair listing and
ROW_NUMBER de-duplication in the order of the original cleaning steps."""

from __future__ import annotations

from shelterlens.plans.oracle_incidence import dd, eom, months_cte, q
from shelterlens.plans.params import TRAILING_END, TRAILING_START
from shelterlens.plans.roles import with_roles

TB = "SurgeryID NULLS LAST, SurgeonName NULLS LAST, AssistantName NULLS LAST, Site NULLS LAST, SiteName NULLS LAST"


def _case_lists(col: str, groups, default: str | None) -> str:
    parts = " ".join(f"WHEN {col} IN ({q(vals)}) THEN '{label}'" for vals, label in groups)
    return f"CASE {parts} ELSE {('NULL' if default is None else repr(default))} END"


def _species(cfg) -> str:
    if not cfg.group_species:
        return "a.Species"
    return ("CASE WHEN a.Species = 'Cat' THEN 'Cat' WHEN a.Species = 'Dog' THEN 'Dog' "
            "WHEN a.Species NOT IN ('Dog', 'Cat') THEN 'Special Species' END")


def _sex(cfg) -> str:
    if not cfg.infer_sex:
        return "a.Sex"
    return ("CASE WHEN a.Sex = 'U' AND t.Medication = 'Ovariohysterectomy' THEN 'F' "
            "WHEN a.Sex = 'U' AND t.Medication = 'Orchidectomy' THEN 'M' "
            "WHEN a.Sex = 'F' THEN 'F' WHEN a.Sex = 'M' THEN 'M' ELSE a.Sex END")


def _site(site_groups) -> str:
    if not site_groups:
        return "CAST(NULL AS VARCHAR)"
    return _case_lists("t.SiteName", site_groups, None)


def denominator_ctes(cfg, site_groups) -> str:
    drop = f"AND SurgeryType IS DISTINCT FROM '{cfg.drop_medication}'" if cfg.drop_medication else ""
    out = f"""
s_rows AS (
  SELECT m.ref, a.AnimalID, a.Name, {_species(cfg)} AS Species, {_sex(cfg)} AS Sex, a.DateOfBirth,
         t.ExamTreatmentID AS UniqueSurgeryID, t.ExamID AS SurgeryID, t.Medication AS SurgeryType,
         {_case_lists('t.Medication', cfg.den_category, 'Other')} AS SurgeryCategory, t.StatusDateTime AS SurgeryTs,
         t.SurgeonName, t.AssistantName, {_site(site_groups)} AS Site, t.SiteName, l.Location, l.LastUpdated AS LocationDate,
         t.Rank
  FROM months m
  JOIN ranked t ON t.StatusDateTime BETWEEN m.ref AND {eom('m.ref')}
  JOIN animals a ON a.AnimalID = t.AnimalID AND a.has_details
  LEFT JOIN locations l ON l.AnimalID = a.AnimalID
  WHERE t.Medication IN ({q(cfg.den_medications)})),
s1 AS (SELECT * FROM s_rows WHERE Location IS DISTINCT FROM 'Off Site Clinic' {drop}),
s2 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ref, AnimalID, UniqueSurgeryID
      ORDER BY SurgeryTs, SurgeryType, LocationDate NULLS LAST, Location NULLS FIRST, {TB}) AS rn FROM s1)
  WHERE rn = 1),
s3 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, CAST(SurgeryTs AS DATE) AS SurgeryDate,
      row_number() OVER (PARTITION BY ref, AnimalID, SurgeryType, CAST(SurgeryTs AS DATE)
      ORDER BY SurgeryTs, UniqueSurgeryID, {TB}) AS rn FROM s2)
  WHERE rn = 1),
s4 AS (
  SELECT s3.*, count(*) OVER (PARTITION BY ref, AnimalID, SurgeryDate, SurgeryID) AS num_surg_mapping FROM s3),
den AS (
  SELECT AnimalID, Name, Species, Sex, DateOfBirth, UniqueSurgeryID, SurgeryID, SurgeryType, SurgeryCategory,
         SurgeonName, AssistantName, Site, SiteName, ref AS reference_date, Location, LocationDate, SurgeryDate,
         CASE WHEN num_surg_mapping > 1 THEN 'Multiple' ELSE SurgeryCategory END AS SurgeryCategory_refined,
         num_surg_mapping, Rank
  FROM s4)"""
    if cfg.collapse_multiple:
        out += f""",
den_multi AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY reference_date, AnimalID, SurgeryDate
      ORDER BY SurgeryID, SurgeryTs, UniqueSurgeryID, SurgeryType, {TB}) AS rn
    FROM (SELECT d.*, s.SurgeryTs FROM den d JOIN s3 s ON s.ref = d.reference_date AND s.AnimalID = d.AnimalID
          AND s.UniqueSurgeryID = d.UniqueSurgeryID AND s.SurgeryType = d.SurgeryType
          AND s.SurgeryDate = d.SurgeryDate)
    WHERE SurgeryCategory_refined = 'Multiple')
  WHERE rn = 1),
den_final AS (
  SELECT * EXCLUDE (Location, LocationDate, num_surg_mapping) FROM den WHERE SurgeryCategory_refined <> 'Multiple'
  UNION ALL BY NAME
  SELECT * EXCLUDE (Location, LocationDate, num_surg_mapping, SurgeryTs, SurgeryCategory_refined),
         '{cfg.collapse_multiple}' AS SurgeryCategory_refined FROM den_multi)"""
    else:
        out += ",\nden_final AS (SELECT * FROM den)"
    return out


def numerator_ctes(cfg, site_groups) -> str:
    drop = f"AND SurgeryType IS DISTINCT FROM '{cfg.drop_medication}'" if cfg.drop_medication else ""
    gap = ""
    if cfg.gap_filter:
        gap = """WINDOW g AS (PARTITION BY ref ORDER BY AnimalID, SurgeryType, SxComp, CAST(SurgeryTs AS DATE), CompDate)
  QUALIFY coalesce(date_diff('day', lag(CAST(SurgeryTs AS DATE)) OVER g, CAST(SurgeryTs AS DATE)) > 1, false)
       OR coalesce(CompDate - lag(CompDate) OVER g > INTERVAL 72 HOUR, false)"""
    return f"""
pairs AS (
  SELECT m.ref, a.AnimalID, a.Name, {_species(cfg)} AS Species, {_sex(cfg)} AS Sex, a.DateOfBirth,
         t.ExamID AS SurgeryID, t.Medication AS SurgeryType,
         {_case_lists('t.Medication', cfg.num_category, 'Other')} AS SurgeryCategory, t.StatusDateTime AS SurgeryTs,
         e.Condition AS SxComp, e.DateTimeDiagnosed AS CompDate, {dd('t.DateCreated', 'e.DateCreated')} AS DaysAfterSurgery,
         t.SurgeonName, t.AssistantName, {_site(site_groups)} AS Site, t.SiteName,
         e.ExamConditionID AS UniqueCompID, t.ExamTreatmentID AS UniqueSurgeryID, l.Location, t.Rank
  FROM months m
  JOIN ranked t ON t.StatusDateTime BETWEEN m.ref AND {eom('m.ref')}
  JOIN animals a ON a.AnimalID = t.AnimalID AND a.has_details
  JOIN exam_conditions e ON e.AnimalID = a.AnimalID AND e.DateTimeDiagnosed BETWEEN m.ref AND {eom('m.ref')}
  LEFT JOIN locations l ON l.AnimalID = a.AnimalID
  WHERE t.Medication IN ({q(cfg.num_medications)}) AND e.Condition IN ({q(cfg.complications)})
    AND {dd('t.DateCreated', 'e.DateCreated')} >= -2),
p1 AS (SELECT * EXCLUDE (Location) FROM pairs WHERE Location IS DISTINCT FROM 'Off Site Clinic' {drop}),
p2 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ref, AnimalID, SurgeryType, SxComp
      ORDER BY UniqueSurgeryID, UniqueCompID, SurgeryTs, CompDate, DaysAfterSurgery, {TB}) AS rn FROM p1)
  WHERE rn = 1),
p2g AS (
  SELECT * FROM p2 {gap}),
p3 AS (SELECT * FROM p2g WHERE DaysAfterSurgery = (SELECT min(DaysAfterSurgery) FROM p2g x
                                                 WHERE x.ref = p2g.ref AND x.AnimalID = p2g.AnimalID AND x.SxComp = p2g.SxComp)),
p4 AS (SELECT p3.* EXCLUDE (SurgeryTs, CompDate), CAST(SurgeryTs AS DATE) AS SurgeryDate, CAST(CompDate AS DATE) AS CompDate
       FROM p3),
num AS (
  SELECT AnimalID, Name, Species, Sex, DateOfBirth, SurgeryID, SurgeryType, SurgeryCategory, SxComp, CompDate,
         DaysAfterSurgery, SurgeonName, AssistantName, Site, SiteName, UniqueCompID, UniqueSurgeryID,
         ref AS reference_date, SurgeryDate,
         CASE WHEN count(*) OVER (PARTITION BY ref, AnimalID, SxComp, SurgeryDate) > 1 THEN 'Multiple'
              ELSE SurgeryCategory END AS SurgeryCategory_refined, Rank
  FROM p4)"""


MERGE = """
merged0 AS (
  SELECT AnimalID, Name, Species, Sex, SurgeryType, SurgeryCategory, SurgeryDate, SurgeryCategory_refined, SurgeonName,
         'NoComp' AS Type FROM den_final
  UNION ALL
  SELECT AnimalID, Name, Species, Sex, SurgeryType, SurgeryCategory, SurgeryDate, SurgeryCategory_refined, SurgeonName,
         'Comp' AS Type FROM num),
merged AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, CAST(date_trunc('month', SurgeryDate) AS DATE) AS SurgeryMonth,
      row_number() OVER (PARTITION BY AnimalID, date_trunc('month', SurgeryDate), SurgeryCategory
        ORDER BY Type, SurgeryDate, SurgeryType, SurgeryCategory_refined NULLS LAST, SurgeonName NULLS LAST,
                 Name NULLS LAST, Species NULLS LAST, Sex NULLS LAST) AS rn
    FROM merged0)
  WHERE rn = 1)"""

SHARE = f"""
d AS (
  SELECT CASE WHEN Species = 'Special Species' THEN 'special' ELSE 'cat_dog' END AS SpeciesGroup,
         SurgeryCategory_refined, SurgeryMonth, Type
  FROM merged
  WHERE SurgeryDate >= DATE '{TRAILING_START}' AND SurgeryDate < DATE '{TRAILING_END}'
    AND SurgeryCategory_refined IN ('Spay', 'Neuter')),
grid AS (
  SELECT * FROM (SELECT DISTINCT SpeciesGroup FROM d) CROSS JOIN (SELECT DISTINCT SurgeryCategory_refined FROM d)
  CROSS JOIN (SELECT DISTINCT SurgeryMonth FROM d) CROSS JOIN (SELECT DISTINCT Type FROM d)),
counts AS (SELECT SpeciesGroup, SurgeryCategory_refined, SurgeryMonth, Type, count(*) AS n FROM d
           GROUP BY SpeciesGroup, SurgeryCategory_refined, SurgeryMonth, Type),
pct AS (
  SELECT SpeciesGroup, SurgeryCategory_refined, SurgeryMonth, Type,
         CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY SpeciesGroup, SurgeryCategory_refined, SurgeryMonth)
                                  AS DOUBLE) * 100 AS p
  FROM counts)"""


def surgery_sql(cfg, site_groups, part: str) -> str:
    if part == "rank":
        return with_roles(f"""
WITH {months_cte()}
SELECT t.ExamTreatmentID, t.AnimalID, t.Medication, t.StatusDateTime, m.ref AS reference_date,
       row_number() OVER (PARTITION BY m.ref, t.AnimalID, t.Medication ORDER BY t.StatusDateTime, t.ExamTreatmentID)
         AS Rank
FROM months m JOIN treatments t ON t.StatusDateTime BETWEEN m.ref AND {eom('m.ref')}
WHERE t.Medication IN ({q(cfg.den_medications)})""")
    ctes = [months_cte(), f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY AnimalID, Medication, date_trunc('month', StatusDateTime)
                               ORDER BY StatusDateTime, ExamTreatmentID) AS Rank
  FROM treatments WHERE StatusDateTime <= {eom('CAST(StatusDateTime AS DATE)')})""".strip()]
    if part in ("den", "merged", "share"):
        ctes.append(denominator_ctes(cfg, site_groups).strip())
    if part in ("num", "merged", "share"):
        ctes.append(numerator_ctes(cfg, site_groups).strip())
    if part in ("merged", "share"):
        ctes.append(MERGE.strip())
    if part == "share":
        ctes.append(SHARE.strip())
    final = {
        "den": "SELECT * FROM den_final",
        "num": "SELECT * FROM num",
        "merged": "SELECT * FROM merged",
        "share": ("SELECT g.SpeciesGroup, g.SurgeryCategory_refined, g.SurgeryMonth, g.Type, "
                  "round(coalesce(p.p, 0.0), 1) AS Percentage FROM grid g LEFT JOIN pct p USING "
                  "(SpeciesGroup, SurgeryCategory_refined, SurgeryMonth, Type)"),
    }[part]
    return with_roles("WITH " + ",\n".join(ctes) + "\n" + final)
