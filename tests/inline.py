"""Small studies written out by hand: raw text tables and domain rows with defaults."""

from __future__ import annotations

import datetime as dt

from trialguard import schemas

DM = {"SITEID": "1", "AGE": "40", "SEX": "M", "RACE": "ASIAN", "ARMCD": "PBO", "ARM": "Placebo", "TRTSDT": "2025-01-10", "TRTEDT": "2025-01-20"}
AE = {"AEDECOD": "Headache", "AEBODSYS": "Nervous", "AESTDT": "2025-01-12", "AETOXGR": "1", "AESER": "N"}
LB = {"VISITNUM": "1", "VISIT": "V1", "LBDT": "2025-01-09", "LBTESTCD": "ALT", "LBTEST": "Alanine", "LBORRES": "20", "LBORRESU": "U/L", "LBORNRLO": "10", "LBORNRHI": "40"}


def raw(spark, defaults: dict, rows: list[dict]):
    """A raw text table; each row gives what differs from ``defaults``."""
    names = ["RECNO", "SUBJID", *defaults]
    data = [(i, *({**defaults, **r}[n] for n in names[1:])) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "RECNO long, " + ", ".join(f"`{n}` string" for n in names[1:]))


def dataset(spark, name: str, rows: list[dict]):
    """Rows of an SDTM or ADaM dataset; text that is not given is empty, other values are NULL."""
    spec = schemas.SPECS[name]
    day = dt.date.fromisoformat
    data = [
        tuple(
            day(r[n]) if t.typeName() == "date" and n in r else r.get(n, "" if t.typeName() == "string" else None) for n, t in spec
        )
        for r in rows
    ]
    return spark.createDataFrame(data, schemas.struct(name))
