"""mzML runs as DataFrames: spectra and header parameters.

Tasks find the spectra of their stretch of a file (``mzml_fragments``), Spark
parses each as XML. Only that, the unpacking of the binary arrays and the look at
the file head use Python. A spectrum that cannot be read is an error, or, where
faults are asked for, a row of the fault table; it costs no other spectrum.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from massloom.functions import cv as terms
from massloom.functions.names import run_name
from massloom.functions.numbers import to_number
from massloom.functions.numpress import DECODERS, DEFLATED
from massloom.sources.files import list_files, open_file
from massloom.sources.mzml_fragments import STRETCH, read_fragments

_PARAM = "struct<_accession:string,_name:string,_value:string,_unitName:string>"
_PARAMS = f"referenceableParamGroupRef:array<struct<_ref:string>>,cvParam:array<{_PARAM}>"
_CORRUPT = "_corrupt"
_SPECTRUM = (
    "_index string, _id string, _defaultArrayLength string, "
    f"referenceableParamGroupRef array<struct<_ref:string>>, cvParam array<{_PARAM}>, "
    f"scanList struct<{_PARAMS},scan:array<struct<{_PARAMS},"
    f"scanWindowList:struct<scanWindow:array<struct<{_PARAMS}>>>>>>, "
    "precursorList struct<precursor:array<struct<"
    f"isolationWindow:struct<{_PARAMS}>,"
    f"selectedIonList:struct<selectedIon:array<struct<{_PARAMS}>>>,"
    f"activation:struct<{_PARAMS}>>>>, "
    f"productList struct<product:array<struct<isolationWindow:struct<{_PARAMS}>>>>, "
    f"binaryDataArrayList struct<binaryDataArray:array<struct<{_PARAMS},_arrayLength:string,binary:string>>>, "
    f"{_CORRUPT} string"
)
_CV = "struct<accession:string,name:string,value:string>"


def _whole(owner: Column) -> Column:
    """All parameters of an element, those of the groups it refers to first, with their units; empty for none."""
    none = F.array().cast(f"array<{_PARAM}>")
    referred = F.transform(owner["referenceableParamGroupRef"], lambda r: F.coalesce(F.element_at("groups", r["_ref"]), none))
    return F.concat(F.coalesce(F.flatten(referred), none), F.coalesce(owner["cvParam"], none))


def _params(owner: Column) -> Column:
    return F.transform(
        _whole(owner),
        lambda p: F.struct(
            p["_accession"].alias("accession"), p["_name"].alias("name"), p["_value"].alias("value")
        ),
    )


def _nested(outer: Column, inner) -> Column:
    """Parameters of every element of ``outer``, in order; empty for none."""
    return F.coalesce(F.flatten(F.transform(outer, inner)), F.array().cast(f"array<{_CV}>"))


def _precursor_params(p: Column) -> Column:
    return F.concat(
        _params(p["isolationWindow"]),
        _nested(p["selectedIonList"]["selectedIon"], _params),
        _params(p["activation"]),
    )


# Number types and compressions of binary arrays. Others are refused.
_NUMBERS = {"MS:1000519": "<i4", "MS:1000521": "<f4", "MS:1000522": "<i8", "MS:1000523": "<f8"}
_PLAIN, _ZLIB = "MS:1000576", "MS:1000574"
_PACKINGS = {_PLAIN, _ZLIB, *DECODERS, *DEFLATED, "MS:1003088", "MS:1003089", "MS:1003090"}
_OTHER_NUMBERS = {"MS:1000520", "MS:1001479"}


def unpack_array(raw: bytes, marks: list[str]) -> np.ndarray:
    """The doubles of a binary array with these terms; what is marked otherwise is an error."""
    kinds = [m for m in marks if m in _NUMBERS or m in _OTHER_NUMBERS]
    packings = {m for m in marks if m in _PACKINGS} - {_PLAIN}
    refused = ValueError(f"binary array marked {', '.join(m or '?' for m in marks)}: number type or compression not supported")
    deflated = _ZLIB in packings or bool(packings & set(DEFLATED))
    pressed = [DEFLATED.get(m, m) for m in packings - {_ZLIB}]
    if len(pressed) > 1 or any(m not in DECODERS for m in pressed) or len(kinds) > 1 or any(m not in _NUMBERS for m in kinds):
        raise refused
    if not pressed and not kinds:
        raise refused
    plain = zlib.decompress(raw) if deflated and raw else raw
    if pressed:
        return DECODERS[pressed[0]](plain)
    return np.frombuffer(plain, dtype=_NUMBERS[kinds[0]]).astype("float64")


@F.pandas_udf(ArrayType(DoubleType()))
def _unpack(data: pd.Series, marks: pd.Series, length: pd.Series) -> pd.Series:
    """Base64 texts, already decoded, to doubles; another length than announced is an error."""

    def one(raw: bytes | None, marks_of: list[str], expected: float | None) -> np.ndarray | None:
        if raw is None:
            return None
        values = unpack_array(raw, list(marks_of))
        if expected is not None and not pd.isna(expected) and len(values) != expected:
            raise ValueError(f"binary array of {len(values)} values where {int(expected)} are announced")
        return values

    return pd.Series([one(*row) for row in zip(data, marks, length, strict=True)], dtype=object)


def _array_of(kind: str) -> Column:
    """The data array marked with ``kind``, as an array of doubles."""
    # The struct is picked by its own parameters; a run may store 32-bit m/z
    # next to 64-bit intensities.
    chosen = F.try_element_at(
        F.filter("arrays", lambda a: terms.has_term(_params(a), kind)), F.lit(1)
    )
    marks = F.transform(_params(chosen), lambda p: p["accession"])
    length = F.coalesce(chosen["_arrayLength"], F.col("announced")).try_cast("bigint")
    return _unpack(F.unbase64(F.regexp_replace(chosen["binary"], r"\s+", "")), marks, length)


def _parsed(spark: SparkSession, path: str | list[str], stretch: int) -> DataFrame:
    """Fragments with ``s``, the spectrum that the text stands for, and ``fault``."""
    found = read_fragments(spark, path, stretch)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = found.withColumn("s", F.when(F.col("fault").isNull(), F.from_xml("fragment", _SPECTRUM, options)))
    broken = F.col("fault").isNull() & (F.col("s").isNull() | F.col(f"s.{_CORRUPT}").isNotNull())
    return parsed.withColumn("fault", F.when(broken, F.lit("spectrum is no XML")).otherwise(F.col("fault")))


def _named(frame: DataFrame) -> DataFrame:
    """With the place of the file as Spark's own sources give it, for ``basename``."""
    file = F.element_at(F.split("path", "/"), -1)
    return frame.withColumn("_metadata", F.struct(F.col("path").alias("file_path"), file.alias("file_name")))


def read_spectra(
    spark: SparkSession,
    path: str | list[str],
    basename: Column | None = None,
    on_fault: str = "fail",
    stretch: int = STRETCH,
) -> DataFrame:
    """The ``spectra`` table of mzML files, plain or gzipped.

    ``basename`` replaces the run name taken from the file name. A file is read
    in stretches of ``stretch`` bytes by many tasks, a gzipped one by one; write the
    result as Parquet and share it between all jobs on spectra. A spectrum that
    is broken or a file that is cut off fails the job; with ``on_fault`` "skip"
    it is left to ``read_faults``.
    """
    raw = _named(_parsed(spark, path, stretch))
    if on_fault == "fail":
        text = F.concat(F.col("fault"), F.lit(" at byte "), F.col("start"), F.lit(" of "), F.col("path"))
        # In the filter, so that no later step can leave the check out.
        raw = raw.where(F.when(F.col("fault").isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    else:
        raw = raw.where(F.col("fault").isNull())
    run = basename if basename is not None else run_name(F.col("_metadata.file_name"))
    heads = read_heads(spark, path).select("path", "groups")
    raw = raw.join(heads, "path", "left").select(run.alias("basename"), "groups", "s")
    s = F.col("s")
    precursors = F.transform(
        F.coalesce(s["precursorList"]["precursor"], F.array()),
        lambda p: F.struct(_precursor_params(p).alias("cv")),
    )
    scan_params = _nested(
        s["scanList"]["scan"],
        lambda scan: F.concat(_params(scan), _nested(scan["scanWindowList"]["scanWindow"], _params)),
    )
    arrays = s["binaryDataArrayList"]["binaryDataArray"]
    shaped = raw.select(
        "basename",
        "groups",
        s["_index"].try_cast("bigint").alias("scan_seq"),
        F.coalesce(
            F.regexp_extract(s["_id"], r"scan=([0-9]+)", 1).try_cast("bigint"),
            s["_index"].try_cast("bigint") + 1,
        ).alias("scan_number"),
        F.flatten(F.transform(F.coalesce(s["scanList"]["scan"], F.array()), _whole)).alias("scans"),
        F.coalesce(arrays, F.array()).alias("arrays"),
        s["_defaultArrayLength"].alias("announced"),
        precursors.alias("precursors"),
        # Document order: own, scan, precursor, product and array parameters.
        F.concat(
            _params(s),
            _params(s["scanList"]),
            scan_params,
            _nested(s["precursorList"]["precursor"], _precursor_params),
            _nested(s["productList"]["product"], lambda p: _params(p["isolationWindow"])),
            _nested(arrays, _params),
        ).alias("cv"),
    )
    start = F.try_element_at(F.filter("scans", lambda p: p["_accession"] == terms.TERMS["scan_start"]), F.lit(1))
    minutes = to_number(start["_value"]) / F.when(start["_unitName"] == "second", F.lit(60.0)).otherwise(F.lit(1.0))
    return shaped.select(
        "basename",
        "scan_seq",
        "scan_number",
        terms.last_value(F.col("cv"), terms.TERMS["ms_level"]).try_cast("int").alias("ms_level"),
        minutes.alias("scan_time_min"),
        _array_of(terms.TERMS["mz_array"]).alias("mz"),
        _array_of(terms.TERMS["intensity_array"]).alias("intensity"),
        "cv",
        "precursors",
    )


def read_faults(spark: SparkSession, path: str | list[str], basename: Column | None = None, stretch: int = STRETCH) -> DataFrame:
    """What cannot be read of mzML files: basename, start (byte, -1 for the file as a whole), fault, detail.

    A file that holds another number of whole spectra than its list announces has
    a line that says so.
    """
    parsed = _parsed(spark, path, stretch).select("path", "start", "fault", F.left("fragment", F.lit(80)).alias("detail"))
    broken = parsed.where(F.col("fault").isNotNull())
    read = parsed.where(F.col("fault").isNull()).groupBy("path").agg(F.count("*").alias("whole"))
    heads = read_heads(spark, path).join(read, "path", "left").withColumn("whole", F.coalesce("whole", F.lit(0)))
    lost = heads.where(F.col("announced") != F.col("whole")).select(
        "path",
        F.lit(-1).cast("long").alias("start"),
        F.when(F.col("announced") < 0, "head is no XML").otherwise("spectra missing").alias("fault"),
        F.concat("whole", F.lit(" of "), "announced").alias("detail"),
    )
    run = basename if basename is not None else run_name(F.col("_metadata.file_name"))
    return _named(broken.unionByName(lost)).select(run.alias("basename"), "start", "fault", "detail")


HEADER_DDL = (
    "path string, seq bigint, group string, kind string, accession string, name string, value string"
)

# Header sections and the group name their parameters get.
SECTIONS = {
    "fileDescription": "file_description",
    "instrumentConfigurationList": "instrument",
    "dataProcessingList": "data_processing",
    "run": "run",
}


def _head_events(path: str) -> Iterator[ElementTree.Element]:
    """Elements before the first spectrum as they start, the spectrum list last; reads no further than that."""
    parser = ElementTree.XMLPullParser(["start"])
    with open_file(path) as raw:
        stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
        while block := stream.read(1 << 16):
            parser.feed(block)
            for _, element in parser.read_events():
                yield element
                if element.tag.rpartition("}")[2] == "spectrumList":
                    return


def _head_rows(path: str) -> Iterator[tuple]:
    """Parameters before the first spectrum; those of a group stand where it is referred to."""
    group, seq = None, 0
    named: dict[str, list[tuple]] = {}
    inside = None
    for element in _head_events(path):
        tag = element.tag.rpartition("}")[2]
        if tag in ("mzML", "run"):
            for key, value in element.attrib.items():
                seq += 1
                yield path, seq, "file_metadata", "info", None, key.rpartition("}")[2], value
        group = SECTIONS.get(tag, group)
        if tag in ("softwareList", "referenceableParamGroupList", "sampleList", "scanSettingsList"):
            group = None
        if tag in ("softwareList", *SECTIONS):
            inside = None
        if tag == "referenceableParamGroup":
            inside = named.setdefault(element.get("id"), [])
        params = []
        if tag in ("cvParam", "userParam"):
            params = [("cv" if tag == "cvParam" else "user", element.get("accession"), element.get("name"), element.get("value"))]
            if inside is not None:
                inside += params
        elif tag == "referenceableParamGroupRef":
            params = named.get(element.get("ref"), [])
        for kind, accession, name, value in params if group else []:
            seq += 1
            yield path, seq, group, kind, accession, name, value


HEADS_DDL = f"path string, announced long, groups map<string,array<{_PARAM}>>"


def _head_of(path: str) -> tuple[int | None, dict[str, list[dict]]]:
    """What a head says; -1 spectra where it is no XML."""
    groups: dict[str, list[dict]] = {}
    try:
        return _read_head(path, groups), groups
    except (ElementTree.ParseError, EOFError, OSError, zlib.error):
        return -1, groups


def _read_head(path: str, groups: dict[str, list[dict]]) -> int | None:
    announced, inside = None, None
    for element in _head_events(path):
        tag = element.tag.rpartition("}")[2]
        if tag == "referenceableParamGroup":
            inside = groups.setdefault(element.get("id"), [])
        elif tag in ("softwareList", *SECTIONS):
            inside = None
        elif tag == "cvParam" and inside is not None:
            inside.append({f"_{k}": element.get(k) for k in ("accession", "name", "value", "unitName")})
        elif tag == "spectrumList" and (element.get("count") or "").isdigit():
            announced = int(element.get("count"))
    return announced


def read_heads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, announced, groups): for each file the number of spectra it announces and its parameter groups by id."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["path"]:
                announced, groups = _head_of(file)
                rows = pd.DataFrame({"path": [file], "announced": pd.array([announced], "Int64"), "groups": [groups]})
                yield rows

    return list_files(spark, path).select("path").mapInPandas(heads, HEADS_DDL)


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in HEADER_DDL.split(", ")]
    for batch in batches:
        for path in batch["path"]:
            yield pd.DataFrame(list(_head_rows(path)), columns=columns)


def read_headers(
    spark: SparkSession, path: str | list[str], basename: Column | None = None, glob: str = "*"
) -> DataFrame:
    """Header parameters: basename, seq, group, kind (cv, user, info), accession, name, value.

    Each task opens its files and stops at the spectrum list, so the cost does
    not depend on the size of the runs. Executors must be able to open the
    paths (local, HDFS or object store).
    """
    found = list_files(spark, path, glob, recursive=True).select("path")
    rows = found.mapInPandas(_heads, HEADER_DDL)
    name = basename if basename is not None else run_name(F.regexp_extract("path", r"([^/]*)\z", 1))
    return rows.select(name.alias("basename"), "seq", "group", "kind", "accession", "name", "value")
