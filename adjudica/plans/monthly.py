"""The monthly job: raw registers are read, prepared and written, one folder per register and month."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from adjudica.plans.registers import build_geo_register, prepare_companies, prepare_sites, sites_with_coordinates
from adjudica.sinks.files import write_parquet

REGISTERS = ("companies", "geo", "sites")


@dataclass(frozen=True)
class RawRegisters:
    """Tables as they are delivered; ``coordinates`` (siret, latitude, longitude) may be left out."""

    companies: DataFrame
    sites: DataFrame
    communes: DataFrame
    overseas_communes: DataFrame
    departments: DataFrame
    overseas_departments: DataFrame
    regions: DataFrame
    coordinates: DataFrame | None = None


def _path(folder: str, register: str, month: str) -> str:
    return f"{folder.rstrip('/')}/{register}/month={month}"


def _written(spark: SparkSession, path: str) -> bool:
    """Whether a register was written whole: Spark puts its mark into a folder only when all tasks are done."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def read_registers(spark: SparkSession, folder: str, month: str) -> dict[str, DataFrame]:
    """The registers of a month as they were written."""
    return {name: spark.read.parquet(_path(folder, name, month)) for name in REGISTERS}


def refresh(spark: SparkSession, raw: RawRegisters, folder: str, month: str, again: bool = False) -> dict[str, DataFrame]:
    """Write companies, places and sites of a month, and return them as written.

    A register that a run before left whole isn't made again unless ``again`` is set, so a run that was cut off goes on where it
    stopped. Sites take the names of their places from the register just written. Sites without a number go; a register
    of places without rows stops the run before any site is written, since all sites would lose their places.
    """

    def made(name: str, build) -> DataFrame:
        path = _path(folder, name, month)
        if again or not _written(spark, path):
            write_parquet(build(), path)
        return spark.read.parquet(path)

    places = made(
        "geo",
        lambda: build_geo_register(raw.communes, raw.overseas_communes, raw.departments, raw.overseas_departments, raw.regions),
    )
    if places.isEmpty():
        raise ValueError(f"the register of places of {month} is empty")
    companies = made("companies", lambda: prepare_companies(raw.companies))

    def sites() -> DataFrame:
        found = prepare_sites(raw.sites.where(F.col("siret").isNotNull()), places)
        return found if raw.coordinates is None else sites_with_coordinates(found, raw.coordinates)

    return {"companies": companies, "geo": places, "sites": made("sites", sites)}
