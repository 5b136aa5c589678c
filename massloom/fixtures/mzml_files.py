"""Writes the fixture spectra as mzML runs, with Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


@F.pandas_udf(BinaryType())
def _pack(values, kind, packed):
    import zlib

    import numpy as np
    import pandas as pd

    from massloom.fixtures.numpress_files import ENCODERS

    def one(array, number, is_packed):
        if number in ENCODERS:
            raw = ENCODERS[number](np.asarray(array).tolist())
        else:
            raw = np.asarray(array).astype(number).tobytes()
        return zlib.compress(raw) if is_packed else raw

    return pd.Series([one(*row) for row in zip(values, kind, packed, strict=True)], dtype=object)


def _attribute(text: Column) -> Column:
    escaped = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    return escaped


def _param(p: Column) -> Column:
    def attribute(name: str) -> Column:
        return F.coalesce(F.concat(F.lit(f' {name}="'), _attribute(p[name]), F.lit('"')), F.lit(""))

    return F.concat(F.lit("<cvParam"), attribute("accession"), attribute("name"), attribute("value"), F.lit("/>"))


def _params(cv: Column) -> Column:
    return F.array_join(F.transform(cv, _param), "")


# Terms of the number types, and of the packings plain and deflated.
_TERMS = {"<f4": "MS:1000521", "<f8": "MS:1000523", "<i4": "MS:1000519", "<i8": "MS:1000522"}
_PRESSED = {"linear": ("MS:1002312", "MS:1002746"), "positive": ("MS:1002313", "MS:1002747"), "logged": ("MS:1002314", "MS:1002748")}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _data(values: str, kind: str, number: Column, packed: Column, group: Column | None = None) -> Column:
    """A binary array; where ``group`` names a parameter group, that says how it is stored."""
    precision = F.coalesce(_map(_TERMS)[number], F.lit(_TERMS["<f8"]))
    plain, deflated = (_map({k: v[at] for k, v in _PRESSED.items()})[number] for at in (0, 1))
    encoding = F.when(packed, F.coalesce(deflated, F.lit("MS:1000574"))).otherwise(F.coalesce(plain, F.lit("MS:1000576")))
    own = F.concat(*[F.concat(F.lit('<cvParam accession="'), a, F.lit('" name="array" value=""/>')) for a in (precision, encoding)])
    if group is not None:
        own = F.when(group.isNotNull(), F.concat(F.lit('<referenceableParamGroupRef ref="'), group, F.lit('"/>'))).otherwise(own)
    return F.concat(
        F.lit("<binaryDataArray>"),
        own,
        F.lit(f'<cvParam accession="{kind}" name="array" value=""/>'),
        F.lit("<binary>"),
        F.base64(_pack(F.col(values), number, packed)),
        F.lit("</binary></binaryDataArray>"),
    )


_GROUPS = (
    '<referenceableParamGroupList count="4">'
    + "".join(
        f'<referenceableParamGroup id="level{n}"><cvParam accession="MS:1000511" name="ms level" value="{n}"/></referenceableParamGroup>'
        for n in (1, 2)
    )
    + '<referenceableParamGroup id="deflated"><cvParam accession="MS:1000523" name="array" value=""/>'
    '<cvParam accession="MS:1000574" name="array" value=""/></referenceableParamGroup>'
    '<referenceableParamGroup id="machine"><cvParam accession="MS:1000529" name="instrument serial number" value="7"/>'
    '<userParam name="owner" value="group"/></referenceableParamGroup></referenceableParamGroupList>'
)


def write_mzml(
    spectra: DataFrame,
    path: str,
    integers: bool = False,
    pressed: bool = False,
    groups: bool = False,
    damage: Callable[[Column], Column] | None = None,
) -> None:
    """Folders ``run=<name>`` with one whole run each.

    Even scans are 64-bit and plain, odd ones deflated with 64-bit m/z and
    32-bit intensities. With ``integers`` every fifth scan has its m/z cut to
    32-bit or 64-bit integers. With ``pressed`` m/z are predicted or rounded and
    intensities logged, every eighth scan as without. With ``groups`` the level
    and the storage of odd m/z arrays stand in parameter groups. ``damage``
    changes lines; it sees the columns run, at and n, the run's spectra.
    """
    odd = F.col("scan_seq") % 2 == 1
    whole = F.lit(integers) & (F.col("scan_seq") % 5 == 3)
    mz_kind = F.when(whole & odd, F.lit("<i4")).when(whole, F.lit("<i8")).otherwise(F.lit("<f8"))
    intensity_kind = F.when(odd, F.lit("<f4")).otherwise(F.lit("<f8"))
    if pressed:
        logged = (F.col("scan_seq") % 8 != 5) & (F.coalesce(F.array_min("intensity"), F.lit(0.0)) >= 0)
        mz_kind = F.when(F.col("scan_seq") % 8 == 5, mz_kind).when(F.col("scan_seq") % 4 < 2, F.lit("linear")).otherwise(F.lit("positive"))
        intensity_kind = F.when(logged, F.lit("logged")).otherwise(intensity_kind)
    own = _params(F.col("cv"))
    if groups:
        level = F.concat(F.lit('<referenceableParamGroupRef ref="level'), F.col("ms_level"), F.lit('"/>'))
        own = F.concat(level, _params(F.slice("cv", 2, 1000)))
    spectrum = F.concat(
        F.format_string('<spectrum index="%d" id="controller=0 scan=%d" defaultArrayLength="%d">', "scan_seq", "scan_number", F.size("mz")),
        own,
        F.lit('<scanList count="1"><scan><cvParam accession="MS:1000016" name="scan start time" value="'),
        (F.col("scan_time_min") * 60).cast("decimal(20,3)").cast("string"),
        F.lit('" unitName="second"/></scan></scanList>'),
        F.when(
            F.size("precursors") > 0,
            F.concat(
                F.lit("<precursorList>"),
                F.array_join(
                    F.transform(
                        "precursors",
                        lambda p: F.concat(
                            F.lit("<precursor><isolationWindow>"), _params(F.slice(p["cv"], 1, 3)),
                            F.lit("</isolationWindow><selectedIonList><selectedIon>"), _params(F.slice(p["cv"], 4, 1)),
                            F.lit("</selectedIon></selectedIonList><activation>"), _params(F.slice(p["cv"], 5, 1)),
                            F.lit("</activation></precursor>"),
                        ),
                    ),
                    "",
                ),
                F.lit("</precursorList>"),
            ),
        ).otherwise(F.lit("")),
        F.lit("<binaryDataArrayList>"),
        _data("mz", "MS:1000514", mz_kind, odd, F.when(odd, F.lit("deflated")) if groups else None),
        _data("intensity", "MS:1000515", intensity_kind, odd),
        F.lit("</binaryDataArrayList></spectrum>"),
    )
    body = spectra.select(F.col("basename").alias("run"), F.col("scan_seq").alias("at"), spectrum.alias("line"))
    runs = body.groupBy("run").agg(F.count("*").alias("n"))
    head = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?><mzML xmlns="http://psi.hupo.org/ms/mzml" version="1.1.0" id="'),
        F.col("run"),
        F.lit(
            '"><fileDescription><fileContent><cvParam accession="MS:1000580" name="MSn spectrum" value=""/>'
            '<userParam name="origin" value="fixture"/></fileContent></fileDescription>'
            + (_GROUPS if groups else "")
            + '<softwareList count="1"><software id="s"><cvParam accession="MS:1000615" name="converter" value=""/>'
            '</software></softwareList>'
            '<instrumentConfigurationList count="1"><instrumentConfiguration id="i">'
            + ('<referenceableParamGroupRef ref="machine"/>' if groups else "")
            +             '<cvParam accession="MS:1000031" name="instrument model"/><userParam value="anonymous"/>'
            '</instrumentConfiguration></instrumentConfigurationList>'
            '<dataProcessingList count="1"><dataProcessing id="d"><processingMethod order="0">'
            '<cvParam accession="MS:1000544" name="" value="to mzML"/></processingMethod></dataProcessing>'
            '</dataProcessingList><run id="r" startTimeStamp="2024-01-01T00:00:00Z">'
            '<cvParam accession="MS:1000580" name="again" value="late"/><spectrumList count="'
        ),
        F.col("n"),
        F.lit('">'),
    )
    heads = runs.select("run", "n", F.lit(-1).cast("bigint").alias("at"), head.alias("line"))
    tails = runs.select(
        "run", "n", F.lit(1 << 60).alias("at"), F.lit("</spectrumList></run></mzML>").alias("line")
    )
    lines = body.withColumn("n", F.lit(None).cast("long")).unionByName(heads).unionByName(tails)
    if damage:
        lines = lines.withColumn("line", damage(F.col("line")))
    (
        lines.repartition("run")
        .sortWithinPartitions("run", "at")
        .select("run", "line")
        .write.partitionBy("run")
        .text(path)
    )
