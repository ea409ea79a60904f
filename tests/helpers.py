"""Small things several tests need."""

from __future__ import annotations

import io
import struct
import zipfile


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def checks(frame) -> dict:
    return {r["check"]: r for r in frame.collect()}


def dbf_bytes(fields, records, encoding="latin-1", claimed=None, extra_header=b""):
    """``fields``: (name, kind, size); ``records``: (flag, [text, ...]).

    A name that ends in ``_2`` has two decimal places.
    """
    record_bytes = 1 + sum(size for _, _, size in fields)
    header_bytes = 32 + 32 * len(fields) + 1 + len(extra_header)
    out = io.BytesIO()
    count = len(records) if claimed is None else claimed
    out.write(struct.pack("<4BIHH20x", 3, 24, 1, 1, count, header_bytes, record_bytes))
    for name, kind, size in fields:
        out.write(struct.pack("<11sc4xBB14x", name.encode(), kind.encode(), size, 2 * name.endswith("_2")))
    out.write(b"\r" + extra_header)
    for flag, values in records:
        out.write(flag.encode())
        for (_, kind, size), value in zip(fields, values):
            raw = value.encode(encoding)
            out.write(raw.rjust(size) if kind == "N" else raw.ljust(size))
    out.write(b"\x1a")
    return out.getvalue()


def write_zip(path, members: dict[str, bytes]) -> None:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)


PREAMBLE = [
    "REGIAO:;SE",
    "UF:;SP",
    "ESTACAO:;MARÍLIA",
    "CODIGO (WMO):;A716",
    "LATITUDE:;-22,23",
    "LONGITUDE:;-49,96",
    "ALTITUDE:;660,59",
    "DATA DE FUNDACAO:;2006-07-25",
    "Data;Hora UTC;PRECIPITAÇÃO",
]


def station_text(lines, preamble=PREAMBLE) -> bytes:
    return ("\r\n".join([*preamble, *lines]) + "\r\n").encode("latin-1")
