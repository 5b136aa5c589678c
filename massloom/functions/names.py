"""Column expressions on paths, file names and FTP addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes that mark a compressed file and a sample file.
COMPRESSION_SUFFIXES = ["gz", "zip", "7z", "bz2", "xz"]
SAMPLE_SUFFIXES = ["raw", "d", "mgf", "mzml", "wiff", "wiff2"]
# Fixed value: the host that is reached over TLS.
TLS_HOST = "massive-ftp.ucsd.edu"

_COMPRESSION = r"\.(" + "|".join(COMPRESSION_SUFFIXES) + ")"
_SAMPLE = r"\.(" + "|".join(SAMPLE_SUFFIXES) + ")"
_ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:([^/?#]*)@)?([^/?#@:]*)(?::([0-9]*))?([^?#]*)"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """The path without its last name and the slash before it."""
    return F.substring(path, F.lit(1), F.length(path) - F.length(base_name(path)) - 1)


def sample_id(repository_id: Column, path: Column) -> Column:
    """Repository id and lower-cased file name without its known suffixes.

    At most one compression suffix goes, then at most one sample suffix.
    """
    name = F.regexp_replace(F.lower(base_name(path)), _COMPRESSION + r"\z", "")
    return F.concat(repository_id, F.lit("_"), F.regexp_replace(name, _SAMPLE + r"\z", ""))


def is_sample_name(path: Column) -> Column:
    return F.lower(base_name(path)).rlike(_SAMPLE + "(" + _COMPRESSION + r")?\z")


def output_name(sample: Column, path: Column) -> Column:
    """Local file name: the sample id with the suffixes of the remote file."""
    name = F.lower(base_name(path))
    compression = F.regexp_extract(name, _COMPRESSION + r"\z", 1)
    kind = F.regexp_extract(name, _SAMPLE + "(?:" + _COMPRESSION + r")?\z", 1)
    return F.concat_ws(".", sample, F.nullif(kind, F.lit("")), F.nullif(compression, F.lit("")))


def run_name(file_name: Column) -> Column:
    """Run name of a spectra file: its name without .mzML/.mzml and .gz."""
    return F.regexp_replace(file_name, r"\.mz(ML|ml)(\.gz)?\z", "")


def is_blank(text: Column) -> Column:
    """Empty or nothing but Unicode white space; null for null."""
    return text.rlike(r"(?U)^\s*\z")


def safe_file_name(text: Column) -> Column:
    return F.translate(text, "/\\ :", "____")


def stratum_key(*columns: str) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("NULL")) for c in columns])


def ftp_parts(url: Column) -> dict[str, Column]:
    """Host, port, user, password, path and TLS flag of an FTP address."""

    def part(group: int) -> Column:
        return F.regexp_extract(url, _ADDRESS, group)

    login = part(1)
    host = F.lower(part(2))
    port = F.nullif(part(3).try_cast("int"), F.lit(0))
    path = F.regexp_replace(F.regexp_replace(part(4), r";[^/]*\z", ""), r"/+\z", "")
    return {
        "host": F.nullif(host, F.lit("")),
        "port": F.coalesce(port, F.lit(21)),
        "user": F.coalesce(F.nullif(F.regexp_extract(login, "^([^:]*)", 1), F.lit("")), F.lit("anonymous")),
        "password": F.regexp_extract(login, "^[^:]*:(.*)$", 1),
        "path": F.coalesce(F.nullif(path, F.lit("")), F.lit("/")),
        "tls": F.contains(host, F.lit(TLS_HOST)),
    }
