"""Small files and folders of whatever store a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _store(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names within a folder, sorted; none if it is absent."""
    if not exists(spark, folder):
        return []
    return sorted(f.getPath().getName() for f in _store(spark, folder).listStatus(_path(spark, folder)))


def listing(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Path within the folder, length and time of change of every file below it, sorted."""
    root = _path(spark, folder)
    files = _store(spark, folder).listFiles(root, True)
    base = _store(spark, folder).makeQualified(root).toUri().getPath().rstrip("/")
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toUri().getPath()[len(base) + 1 :], f.getLen(), f.getModificationTime()))
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    _store(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _store(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file in one step: it is there as a whole or not at all. False if the name is taken."""
    folder, _, name = path.rpartition("/")
    aside = f"{folder}/.{name}.{spark._jvm.java.util.UUID.randomUUID().toString()}"
    store = _store(spark, path)
    store.mkdirs(_path(spark, folder))
    out = store.create(_path(spark, aside), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(store.makeQualified(_path(spark, aside)), store.makeQualified(_path(spark, path)), plain)
    except Exception as error:
        delete(spark, aside)
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True
