"""Moving and removing folders on whatever file system holds them, by Spark's own Hadoop client."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, uri: str) -> None:
    files, path = _place(spark, uri)
    files.delete(path, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a written folder in the place of another.

    A rename where both are on one file system, else a copy that then loses its source.
    """
    from_files, from_path = _place(spark, source)
    to_files, to_path = _place(spark, target)
    to_files.delete(to_path, True)
    to_files.mkdirs(to_path.getParent())
    if from_files.getUri().equals(to_files.getUri()) and from_files.rename(from_path, to_path):
        return
    copied = spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        from_files, from_path, to_files, to_path, True, spark._jsc.hadoopConfiguration())
    if not copied:
        raise OSError(f"{source} could not be put in the place of {target}")


def exists(spark: SparkSession, uri: str) -> bool:
    files, path = _place(spark, uri)
    return files.exists(path)


def file_names(spark: SparkSession, uri: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder."""
    files, path = _place(spark, uri)
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def create_marker(spark: SparkSession, uri: str) -> None:
    """An empty file that must not exist yet."""
    files, path = _place(spark, uri)
    files.mkdirs(path.getParent())
    files.create(path, False).close()


def join_parts(spark: SparkSession, folder: str, target: str, header: bytes) -> None:
    """The part files of a folder as one file: a header, then every part without its own, in the order of their names.

    Written under a hidden name first and renamed over the target.
    """
    files, path = _place(spark, target)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    beside = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}")
    out = files.create(beside, True)
    try:
        out.write(bytearray(header))
        for name in sorted(n for n in file_names(spark, folder) if n.startswith("part-")):
            part = files.open(jvm.org.apache.hadoop.fs.Path(folder, name))
            try:
                part.seek(min(len(header), files.getFileStatus(jvm.org.apache.hadoop.fs.Path(folder, name)).getLen()))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            finally:
                part.close()
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(beside, path, options)
