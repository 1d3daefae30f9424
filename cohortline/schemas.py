"""Column names and Spark types of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STR, INT, LONG, DBL, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
STRINGS = T.ArrayType(STR)

# ---- catalog -------------------------------------------------------------------------------
SUBJECTS = _struct(project_id=STR, subject_key=STR, subject_id=STR, subject_uri=STR)
EXPERIMENTS = _struct(project_id=STR, subject_key=STR, exp_key=STR, exp_ordinal=LONG, modality=STR, label=STR)
SCANS = _struct(project_id=STR, exp_key=STR, scan_key=STR, scan_ordinal=LONG, series_description=STR, uri=STR)
RESOURCES = _struct(project_id=STR, owner_key=STR, uri=STR, resource_files=STRINGS)

#: Order of a scan inside its subject: experiments first, then scans inside the experiment.
POSITION = ("exp_ordinal", "exp_key", "scan_ordinal", "scan_key")

# ---- images --------------------------------------------------------------------------------
IMAGE = _struct(height=INT, width=INT, pixels=T.ArrayType(DBL))
#: As images are stored and end a chain.
IMAGE32 = _struct(height=INT, width=INT, pixels=T.ArrayType(T.FloatType()))

# ---- record tables -------------------------------------------------------------------------
PERSON_REF = _struct(name=STR, id=STR)
APPROVAL = _struct(id=STR, reviewer=PERSON_REF, content=STR)
STEP = _struct(step=INT, result=STR, req_ids=STRINGS, note=STR)

# Kinds and field names of the records.
RECORDS: dict[str, T.StructType] = {
    "requirements": _struct(project_id=STR, id=STR, title=STR, type=STR, description=STR),
    "specifications": _struct(project_id=STR, id=STR, title=STR, req_id=STR, description=STR),
    "auto_tests": _struct(
        project_id=STR, kind=STR, test_key=STR, name=STR, message=STR, result=STR, req_ids=STRINGS, note=STR
    ),
    "manual_tests": _struct(project_id=STR, name=STR, steps=T.ArrayType(STEP)),
    "change_requests": _struct(
        project_id=STR, id=STR, title=STR, content=STR, url=STR, is_problem_report=BOOL, change_ids=STRINGS
    ),
    "changes": _struct(
        project_id=STR,
        id=STR,
        content=STR,
        url=STR,
        approvals=T.ArrayType(APPROVAL),
        authors=T.ArrayType(PERSON_REF),
    ),
    "risks": _struct(
        project_id=STR,
        id=STR,
        hazard=STR,
        software_item=STR,
        events=STR,
        hazardous_situation=STR,
        harm=STR,
        severity=STR,
        probability=STR,
        control_measures=STR,
        residual_severity=STR,
        residual_probability=STR,
        notes=STR,
    ),
    "soup": _struct(
        project_id=STR,
        title=STR,
        manufacturer=STR,
        version=STR,
        purpose=STR,
        requirements=STR,
        anomaly_reference=STR,
        relevant_anomalies=STR,
    ),
    "people": _struct(project_id=STR, name=STR, roles=STRINGS, git_host_usernames=STRINGS),
    "versions": _struct(project_id=STR, position=LONG, date=STR, release_id=STR, changes=STRINGS),
    "device": _struct(project_id=STR, name=STR, version=STR, safety_class=STR, mhra_class=STR),
    "definitions": _struct(project_id=STR, term=STR, text=STR),
    "commits": _struct(project_id=STR, sha=STR, subject=STR, body=STR),
    "anomalies": _struct(project_id=STR, component=STR, anomaly_id=STR, priority=STR, portion_used=BOOL),
}
