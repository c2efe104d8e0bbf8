"""DuckDB oracle SQL for the incidence queries.

Written from the rules, in another form than the Spark plans: the events of an animal are
gathered into lists, and a rule is a filter over the lists of one (animal, month).
"""

from __future__ import annotations

from shelterlens.plans.params import AS_OF, START_YEAR, TRAILING_END, TRAILING_START
from shelterlens.plans.roles import with_roles


def q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def wk(a: str, b: str) -> str:
    """Sunday boundaries crossed from a to b."""
    return (f"(floor(date_diff('day', DATE '1970-01-04', CAST({b} AS DATE)) / 7.0) - "
            f"floor(date_diff('day', DATE '1970-01-04', CAST({a} AS DATE)) / 7.0))")


def dd(a: str, b: str) -> str:
    return f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"


def months_cte(first: str | None = None, last: str | None = None) -> str:
    first = first or f"{START_YEAR}-01-01"
    last = last or f"{AS_OF.year}-{AS_OF.month:02d}-01"
    return (f"months AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', "
            f"INTERVAL 1 MONTH)) AS DATE) AS ref)")


def eom(ref: str) -> str:
    return f"CAST(last_day({ref}) AS TIMESTAMP)"


def agegroup(dob: str, ref: str, species: str) -> str:
    return (f"CASE WHEN {wk(dob, ref)} >= 20 THEN 'Adult' "
            f"WHEN {wk(dob, ref)} < 20 AND {species} = 'Cat' THEN 'Kitten' ELSE 'Puppy' END")


def listed_ctes(d) -> str:
    """Animals of the report with the intakes that count, as one list each."""
    return f"""
who AS (
  SELECT AnimalID AS animalid, Name AS name, Species AS species, DateOfBirth AS dateofbirth,
         (SELECT list({{'at': v.tin_DateCreated, 'kind': v.IntakeType}}) FROM visits v
          WHERE v.AnimalID = animals.AnimalID AND v.IntakeType IN ({q(d.intake_types)})) AS intakes
  FROM animals WHERE has_details AND Species IN ({q(d.species)})),
sick AS (
  SELECT AnimalID AS animalid, Condition AS condition, CAST(date_trunc('month', DateCreated) AS DATE) AS ref,
         list(DateCreated) AS exams
  FROM exam_conditions
  WHERE Condition IN ({q(d.conditions)}) AND DateCreated <= {eom("CAST(DateCreated AS DATE)")}
    AND CAST(date_trunc('month', DateCreated) AS DATE) IN (SELECT ref FROM months)
  GROUP BY ALL)"""


def _within(lo: int, hi: int) -> str:
    return f"i.at < e AND {dd('i.at', 'e')} BETWEEN {lo} AND {hi}"


def numerator_cte(d) -> str:
    rule = _within(*d.onset_days)
    return f"""
onset AS (
  SELECT who.*, sick.condition, sick.ref,
         list_filter(intakes, lambda i: len(list_filter(exams, lambda e: {rule})) > 0) AS causes,
         list_filter(exams, lambda e: len(list_filter(intakes, lambda i: {rule})) > 0) AS effects
  FROM sick JOIN who USING (animalid)
  WHERE intakes IS NOT NULL AND dateofbirth IS NOT NULL),
num AS (
  SELECT animalid, name, species, dateofbirth, list_max(list_transform(causes, lambda i: i.kind)) AS Intaketype,
         condition, list_max(list_transform(causes, lambda i: i.at)) AS intakedate, list_min(effects) AS examdate,
         ref AS Referencedate, {agegroup('dateofbirth', 'ref', 'species')} AS Agegroup
  FROM onset WHERE len(effects) > 0)"""


def stock_cte(d) -> str:
    year = "(ref - INTERVAL 1 YEAR)"
    return f"""
held AS (
  SELECT who.animalid, who.name, who.species, who.dateofbirth, list({{'at': s.LastUpdated, 'stage': s.Stage,
         'active': s.Status = 'A', 'came': v.tin_DateCreated}}) AS events
  FROM who JOIN statuses s ON s.AnimalID = who.animalid
  LEFT JOIN visits v ON v.InPrimaryKey = s.OperationPrimaryID AND v.AnimalID = s.AnimalID
  WHERE s.Stage IN ({q(d.stages)}) AND coalesce(v.IntakeType IN ({q(d.intake_types)}), TRUE)
  GROUP BY ALL),
seen AS (
  SELECT held.* EXCLUDE (events), ref, list_filter(events, lambda x: x.at >= {year}
         AND coalesce(x.came >= {year}, TRUE)) AS events
  FROM held, months WHERE dateofbirth IS NOT NULL),
newest AS (
  SELECT *, list_max(list_transform(list_filter(events, lambda x: x.at > {year} AND x.at <= ref), lambda x: x.at)) AS top,
         list_max(list_transform(list_filter(events, lambda x: x.came < ref), lambda x: x.came)) AS came
  FROM seen),
stock AS (
  SELECT animalid, name, species, dateofbirth, top AS stagedate, 'A' AS status,
         list_min(list_transform(list_filter(events, lambda x: x.active AND x.at = top), lambda x: x.stage)) AS stage,
         came AS intakedate, ref AS Referencedate, {agegroup('dateofbirth', 'ref', 'species')} AS Agegroup
  FROM newest WHERE came IS NOT NULL AND len(list_filter(events, lambda x: x.active AND x.at = top)) > 0)"""


def flow_cte(d) -> str:
    rule = _within(*d.early_days)
    return f"""
early AS (
  SELECT who.animalid, sick.ref FROM sick JOIN who USING (animalid)
  WHERE len(list_filter(exams, lambda e: len(list_filter(intakes, lambda i: {rule})) > 0)) > 0),
flow AS (
  SELECT who.animalid, name, species, dateofbirth, CAST(ref AS TIMESTAMP) AS stagedate, 'A' AS status,
         'Intake' AS stage, max(v.tin_DateCreated) AS intakedate, ref AS Referencedate,
         {agegroup('dateofbirth', 'ref', 'species')} AS Agegroup
  FROM who JOIN visits v ON v.AnimalID = who.animalid
  JOIN months ON ref = CAST(date_trunc('month', v.tin_DateCreated) AS DATE)
  WHERE v.IntakeType IN ({q(d.intake_types)}) AND v.tin_DateCreated < {eom('ref')} AND dateofbirth IS NOT NULL
    AND (v.InPrimaryKey, v.tin_DateCreated, 'Completed') IN
        (SELECT (OperationRecordID, StatusDateTime, OperationStatus) FROM intake_status)
    AND (who.animalid, ref) NOT IN (SELECT (animalid, ref) FROM early)
  GROUP BY ALL)"""


def chart_cte(d) -> str:
    body = """
den AS (SELECT * FROM stock UNION ALL SELECT * FROM flow),
chart0 AS (
  SELECT animalid, species, Agegroup, 'Healthy' AS Outcome, 'Denominator' AS Intaketype, Referencedate, 1 AS sum FROM den
  UNION ALL
  SELECT animalid, species, Agegroup, 'Infected' AS Outcome, Intaketype, Referencedate, 1 AS sum FROM num)"""
    if not d.weighted:
        return body + ",\nchart AS (SELECT * EXCLUDE (sum) FROM chart0)"
    if not d.gap_fill:
        return body + ",\nchart AS (SELECT * FROM chart0)"
    return body + """,
rng AS (SELECT min(Referencedate) AS lo, max(Referencedate) AS hi FROM chart0),
allm AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)
         AS Referencedate FROM rng),
grid AS (SELECT * FROM (VALUES ('Dog', 'Adult'), ('Dog', 'Puppy'), ('Cat', 'Adult'), ('Cat', 'Kitten')) g(species, Agegroup)),
fill AS (
  SELECT CAST(NULL AS BIGINT) AS animalid, g.species, g.Agegroup, 'Infected' AS Outcome, CAST(NULL AS VARCHAR) AS Intaketype,
         m.Referencedate, 0 AS sum
  FROM allm m, grid g
  WHERE NOT EXISTS (SELECT 1 FROM chart0 c WHERE c.Outcome = 'Infected' AND c.species = g.species
                    AND c.Agegroup = g.Agegroup AND c.Referencedate = m.Referencedate)),
chart AS (SELECT * FROM chart0 UNION ALL SELECT * FROM fill)"""


def incidence_sql(d, part: str) -> str:
    ctes = [months_cte(), listed_ctes(d).strip()]
    if part in ("numerator", "chart", "percent"):
        ctes.append(numerator_cte(d).strip())
    if part in ("stock", "population", "chart", "percent"):
        ctes.append(stock_cte(d).strip())
    if part in ("flow", "population", "chart", "percent"):
        ctes.append(flow_cte(d).strip())
    if part in ("chart", "percent"):
        ctes.append(chart_cte(d).strip())
    final = {
        "numerator": "SELECT * FROM num",
        "stock": "SELECT * FROM stock",
        "flow": "SELECT * FROM flow",
        "population": "SELECT * FROM stock UNION ALL SELECT * FROM flow",
        "chart": "SELECT * FROM chart",
        "percent": f"""
SELECT species, Month, Agegroup,
       round(CASE WHEN Healthy = 0 THEN NULL ELSE CAST(Infected AS DOUBLE) / CAST(Healthy AS DOUBLE) * 100 END, 2)
         AS infection_percent
FROM (SELECT species, Referencedate AS Month, Agegroup,
             coalesce(sum(sum) FILTER (WHERE Outcome = 'Healthy'), 0) AS Healthy,
             coalesce(sum(sum) FILTER (WHERE Outcome = 'Infected'), 0) AS Infected
      FROM chart
      WHERE Referencedate >= DATE '{TRAILING_START}' AND Referencedate < DATE '{TRAILING_END}'
      GROUP BY species, Referencedate, Agegroup) p""",
    }[part]
    return with_roles("WITH " + ",\n".join(ctes) + "\n" + final)
