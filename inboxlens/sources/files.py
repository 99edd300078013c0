"""Small file operations of the shared file system: delete, list, replace in one step."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where there is none."""
    _system(spark, path).delete(_path(spark, path), True)


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, for folders whose number is bounded."""
    found = _system(spark, pattern).globStatus(_path(spark, pattern))
    return [f.getPath().toString() for f in found or []]


def usage(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of the data files in a folder."""
    found = _system(spark, path).listStatus(_path(spark, path))
    sizes = [f.getLen() for f in found if f.getPath().getName()[0] not in "._"]
    return sum(sizes), len(sizes)


def move(spark: SparkSession, source: str, target: str) -> None:
    if not _system(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False, with nothing changed, where the file exists."""
    system = _system(spark, path)
    system.mkdirs(_path(spark, path).getParent())
    try:
        out = system.create(_path(spark, path), False)
    except Exception as failure:
        if exists(spark, path) and "FileAlreadyExists" in str(failure):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    if not exists(spark, path):
        return None
    jvm = spark.sparkContext._jvm
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, text: str, token: str) -> None:
    """Give a small file new content by one rename over it: readers see the old or the new one."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    beside = f"{path}.{token}"
    drop(spark, beside)
    if not create(spark, beside, text):
        raise OSError(f"could not write {beside}")
    fs = jvm.org.apache.hadoop.fs
    over = gateway.new_array(getattr(fs, "Options$Rename"), 1)
    over[0] = getattr(fs, "Options$Rename").OVERWRITE
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    context = fs.FileContext.getFileContext(_path(spark, path).toUri(), configuration)
    context.rename(_path(spark, beside), _path(spark, path), over)
