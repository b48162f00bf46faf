"""Small file-system questions, asked through Hadoop so any store works."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _path(spark, path)
    fs.mkdirs(hadoop_path)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; the folder above its new place is made, and nothing may be there yet."""
    fs, hadoop_path = _path(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(hadoop_path, target):
        raise OSError(f"{path} could not be moved to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    fs, hadoop_path = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there whole or not at all: written beside its place and renamed."""
    fs, hadoop_path = _path(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(hadoop_path, False)
    if not fs.rename(beside, hadoop_path):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Files, bytes and newest change time below a path: tells whether input changed."""
    fs, hadoop_path = _path(spark, path)
    status = fs.getFileStatus(hadoop_path)
    if not status.isDirectory():
        return 1, status.getLen(), status.getModificationTime()
    count = size = 0
    changed = status.getModificationTime()
    found = fs.listFiles(hadoop_path, True)
    while found.hasNext():
        one = found.next()
        count, size = count + 1, size + one.getLen()
        changed = max(changed, one.getModificationTime())
    return count, size, changed


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet below `path`, or no rows of that schema when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def newest_version(spark: SparkSession, base: str) -> int:
    """Highest N of the finished `v=N` folders below `base`, -1 if there is none."""
    fs, hadoop_path = _path(spark, base)
    if not fs.exists(hadoop_path):
        return -1
    found = [int(s.getPath().getName()[2:]) for s in fs.listStatus(hadoop_path)
             if s.getPath().getName().startswith("v=")
             and exists(spark, f"{s.getPath().toString()}/_SUCCESS")]
    return max(found, default=-1)
