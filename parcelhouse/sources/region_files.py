"""Scans of per-session region tables (tab-separated, one file per session and measure).

A file holds one row per region, so it is small and is read whole; its header decides
where each column is. Files whose columns differ in number or order are read in one job.
All columns of the vocabulary are typed; every other one is kept in the map ``extras``.
"""

import re
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from parcelhouse.functions import bids_entities, numeric_or_null
from parcelhouse.model import (
    LONG_SCHEMA,
    REGION_ALIASES,
    REGION_FIELDS,
    SESSION_KEYS,
    STATISTIC_FIELDS,
    TISSUES,
)
from parcelhouse.operators.sessions import attach, only_sessions

# Cell texts that mean "missing".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
REGION_NAME_COLUMN = "name"
#: Files and bytes that a task reads, and files that it lists, before it hands them on.
_READ_FILES, _READ_BYTES, _LISTED = 1000, 8 << 20, 10_000
_FILE_FIELDS = [T.StructField("file_path", T.StringType()), T.StructField("text", T.StringType())]


def read_files(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """``(file_path, text)`` of all files below ``root`` with such a name."""
    return read_listed(list_files(spark, root, name_glob), root, strict=True)


def read_listed(files: DataFrame, root: str, strict: bool = False) -> DataFrame:
    """``(file_path, text)`` of listed files below ``root``. Those that can't be read, or are gone, are
    an error if ``strict`` and else left out.

    The tasks open the files; no path goes through the driver where Arrow reaches the file system.
    """
    spark = files.sparkSession
    place = _arrow_place(spark, root)
    if place is None:
        return _read_by_spark(files, strict)
    base, uri = place

    def read(batches):
        from pyarrow import fs

        target, at = fs.FileSystem.from_uri(uri)

        def packed(paths, texts):
            return pa.record_batch({"file_path": pa.array(paths, pa.string()), "text": pa.array(texts, pa.binary())})

        paths, texts, size = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with target.open_input_stream(at + path[len(base) :], compression=None) as stream:
                        text = stream.read()
                except OSError:
                    if strict:
                        raise
                    continue
                paths.append(path)
                texts.append(text)
                size += len(text)
                if size > _READ_BYTES or len(paths) >= _READ_FILES:
                    yield packed(paths, texts)
                    paths, texts, size = [], [], 0
        if paths:
            yield packed(paths, texts)

    dealt = files.select("file_path").repartition(_parts(spark), "file_path")
    read_ = dealt.mapInArrow(read, "file_path string, text binary")
    return read_.select("file_path", F.col("text").cast("string").alias("text"))


def _read_by_spark(files: DataFrame, strict: bool) -> DataFrame:
    """The same for file systems that only Spark reaches; the driver hands the paths to the reader."""
    spark = files.sparkSession
    paths = [r.file_path for r in files.select("file_path").collect()]
    if not paths:
        return spark.createDataFrame([], T.StructType(_FILE_FIELDS))
    exact = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]
    skip = str(not strict).lower()
    reader = spark.read.options(ignoreCorruptFiles=skip, ignoreMissingFiles=skip)
    return reader.text(exact, wholetext=True).select(
        _decoded_path().alias("file_path"), F.col("value").alias("text")
    )


def _decoded_path() -> Column:
    # Paths are URIs; a literal plus sign must survive the decoding.
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _arrow_place(spark, root: str):
    """The root as file paths name it and as Arrow opens it; None if Arrow doesn't reach it."""
    from pyarrow import fs

    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    at = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    head = f"{at.getScheme()}://{at.getAuthority() or ''}"
    uri = head + quote(at.getPath())
    try:
        target, path = fs.FileSystem.from_uri(uri)
        target.get_file_info(path)
    except (OSError, ValueError, ImportError, NotImplementedError):
        return None
    # Without an authority a URI prints as in file:/folder; paths in older ledgers do.
    name = head if at.getAuthority() else f"{at.getScheme()}:"
    return name + at.getPath().rstrip("/"), uri.rstrip("/")


def _name_pattern(name_glob: str) -> str:
    """A file name's glob (stars, question marks, alternatives in braces) as a regular expression."""
    signs = {"*": ".*", "?": ".", "{": "(?:", "}": ")", ",": "|"}
    return "".join(signs.get(c) or re.escape(c) for c in name_glob)


def list_files(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """``file_path, length, modified`` of all files below ``root`` with such a name; contents are not
    read. ``modified`` counts microseconds, by whole milliseconds. As in Spark's readers, hidden names and files
    without a single byte don't count.

    The tasks list: the root, its folders, theirs, and what lies below those. Nothing of it goes through
    the driver where Arrow reaches the file system.
    """
    place = _arrow_place(spark, root)
    if place is None:
        return _listed_by_spark(spark, root, name_glob)
    base, uri = place
    wanted = _name_pattern(name_glob)
    fields = "file_path string, length bigint, modified bigint, folder boolean"
    schema = pa.schema([("file_path", pa.string()), ("length", pa.int64()), ("modified", pa.int64()),
                        ("folder", pa.bool_())])

    def expanded(recursive):
        def expand(batches):
            """Files as they are; a folder becomes what it holds."""
            from pyarrow import fs

            target, at = fs.FileSystem.from_uri(uri)

            def hidden(path):
                return any(
                    n.startswith(".") or (n.startswith("_") and "=" not in n) or n.endswith("._COPYING_")
                    for n in path.split("/")
                )

            for batch in batches:
                rows = []
                for path, length, modified, folder in zip(*(c.to_pylist() for c in batch.columns)):
                    if not folder:
                        rows.append((path, length, modified, False))
                        continue
                    place = at + path[len(base) :]
                    for f in target.get_file_info(fs.FileSelector(place, allow_not_found=True, recursive=recursive)):
                        below = f.path[len(place) :].lstrip("/")
                        if hidden(below):
                            continue
                        if f.type == fs.FileType.Directory:
                            if not recursive:
                                rows.append((f"{path}/{below}", 0, 0, True))
                        elif f.size and re.fullmatch(wanted, f.base_name):
                            rows.append((f"{path}/{below}", f.size, f.mtime_ns // 1_000_000 * 1000, False))
                    if len(rows) >= _LISTED:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

        return expand

    found = spark.createDataFrame([(base, 0, 0, True)], fields).coalesce(1)
    for recursive in (False, False, True):
        found = found.mapInArrow(expanded(recursive), fields)
        if not recursive:
            found = found.repartition(_parts(spark), "file_path")
    return found.where("NOT folder").drop("folder")


def _listed_by_spark(spark, root, name_glob) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.option("pathGlobFilter", name_glob).load(root)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], "file_path string, length bigint, modified bigint")
        raise
    return files.select(
        _decoded_path().alias("file_path"), "length",
        F.unix_micros("modificationTime").alias("modified"),
    )


def file_problem(text="text") -> Column:
    """Why a region file can't give rows; null if it can."""
    lines = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")
    header = F.transform(F.split(F.regexp_replace(lines[0], "^\ufeff", ""), "\t"), F.trim)

    def lacks(names):
        return ~F.arrays_overlap(header, F.array(*[F.lit(n) for n in names]))

    return (
        F.when(F.trim(F.regexp_replace(text, "\\s", "")) == "", "empty file")
        .when(lacks((*REGION_ALIASES, REGION_NAME_COLUMN)), "no region column")
        .when(lacks([f.name for f in STATISTIC_FIELDS]), "no statistic column")
        .when(F.size(F.filter(lines, lambda x: F.trim(x) != "")) < 2, "no rows")
    )


def file_name(path="file_path") -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parse_tables(files: DataFrame, keep_extras=True) -> DataFrame:
    """Rows of tab-separated files; other columns of ``files`` are repeated on each row."""
    carried = [c for c in files.columns if c != "text"]
    lines = F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")
    header = F.transform(F.split(F.regexp_replace(lines[0], "^\ufeff", ""), "\t"), F.trim)
    split = files.withColumns({"_lines": lines, "_header": header})
    typed = REGION_FIELDS + STATISTIC_FIELDS + [T.StructField(REGION_NAME_COLUMN, T.StringType())]
    # Column positions are looked up once per file, not once per line.
    places = F.expr(
        "struct("
        + ", ".join(
            f"cast(nullif(array_position(_header, '{f.name}'), 0) as int) as {f.name}"
            for f in typed
        )
        + ")"
    )
    other = F.array_distinct(
        F.array_except("_header", F.array(*[F.lit(f.name) for f in typed]))
    )
    rows = split.withColumns({"_places": places, "_other": other}).select(
        *carried, "_header", "_places", "_other",
        F.posexplode("_lines").alias("line_no", "_line"),
    )
    rows = rows.where((F.col("line_no") > 0) & (F.trim("_line") != "")).withColumn(
        "_cells",
        F.transform(
            F.split("_line", "\t", -1), lambda c: F.when(~c.isin(*MISSING_TEXTS), c)
        ),
    )

    def cell(field):
        text = F.try_element_at("_cells", F.col(f"_places.{field.name}"))
        if isinstance(field.dataType, T.StringType):
            return text
        number = numeric_or_null(text)
        return number.try_cast("bigint") if isinstance(field.dataType, T.LongType) else number

    extras = F.map_from_arrays(
        F.col("_other"),
        F.transform(
            "_other",
            lambda c: F.try_element_at(
                "_cells", F.array_position(F.col("_header"), c).cast("int")
            ),
        ),
    )
    return rows.select(
        *carried,
        F.col("line_no").cast("bigint").alias("line_no"),
        *[cell(f).alias(f.name) for f in typed],
        (F.when(F.size("_other") > 0, extras) if keep_extras else F.lit(None))
        .cast("map<string,string>").alias("extras"),
    )


def _session_from_path(files: DataFrame, pattern: str, **groups) -> DataFrame:
    return files.where(F.col("file_path").rlike(pattern)).withColumns(
        {name: F.regexp_extract("file_path", pattern, n) for name, n in groups.items()}
    )


def _canonical(rows: DataFrame) -> DataFrame:
    """The columns of the long table except those the store adds."""
    named = rows.withColumn("label", F.coalesce("label", REGION_NAME_COLUMN)).withColumnRenamed(
        "file_path", "source_path"
    )
    return named.select(
        *[
            (F.col(f.name) if f.name in named.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LONG_SCHEMA.fields
            if f.name not in ("source", "batch_id")
        ]
    )


def anatomical_pattern(atlas: str, tissues) -> str:
    return (
        rf"/sub-([^/]+)/ses-([^/]+)/anat/atlas-{atlas}/"
        rf"[^/]*_tissue-({'|'.join(tissues)})_parc\.tsv$"
    )


def _tissues_of(modalities):
    return [t for t, (modality, _) in TISSUES.items() if not modalities or modality in modalities]


def anatomical_glob(modalities=None) -> str:
    return "*_tissue-{" + ",".join(_tissues_of(modalities)) + "}_parc.tsv"


def anatomical_files(files, atlas, modalities=None) -> DataFrame:
    return _session_from_path(
        files, anatomical_pattern(atlas, _tissues_of(modalities)),
        subject_code=1, session_id=2, tissue=3,
    )


def anatomical_rows(files, atlas, modalities=None):
    """Long rows of tissue files. ``files`` as from :func:`read_files`."""
    found = anatomical_files(files, atlas, modalities)
    tag = F.create_map(
        *[F.lit(x) for t, (modality, metric) in TISSUES.items() for x in (t, f"{modality} {metric}")]
    )
    tags = F.split(tag[F.col("tissue")], " ")
    return _canonical(
        parse_tables(found.withColumns({"modality": tags[0], "metric": tags[1]}))
    )


def scan_anatomical(
    spark, root, atlas="4S456Parcels", sessions=None, modalities=None, totals=None
) -> DataFrame:
    """Long rows of all tissue files of the given sessions (raw ids) and modalities.

    ``totals`` (subject, session, tiv) adds the session total to every row.
    """
    found = anatomical_files(list_files(spark, root, anatomical_glob(modalities)), atlas, modalities)
    if sessions is not None:
        found = only_sessions(found, sessions)
    # Of several files for a session and tissue the first by path counts; no other is read.
    first = found.groupBy(*SESSION_KEYS, "tissue").agg(F.min("file_path").alias("file_path"))
    rows = anatomical_rows(read_listed(first, root, strict=True), atlas, modalities)
    return rows if totals is None else attach(rows.drop("tiv"), totals)


def diffusion_pattern(atlas: str) -> str:
    return rf"/qsirecon-([^/]+)/sub-([^/]+)/ses-([^/]+)/dwi/atlas-{atlas}/[^/]*_parc\.tsv$"


def diffusion_files(files, atlas, workflows=None) -> DataFrame:
    found = _session_from_path(
        files, diffusion_pattern(atlas), workflow=1, subject_code=2, session_id=3
    )
    return found if workflows is None else found.where(F.col("workflow").isin(*workflows))


def diffusion_rows(files, atlas, workflows=None) -> DataFrame:
    """Long rows of diffusion files, tagged from directory and file name."""
    found = diffusion_files(files, atlas, workflows)
    entities = found.withColumn("_entities", bids_entities(file_name()))
    tagged = entities.withColumns(
        {
            c: F.coalesce(F.col("_entities")[c], F.lit("unknown"))
            for c in ("model", "param", "desc")
        }
    ).drop("_entities")
    return _canonical(parse_tables(tagged))


def scan_diffusion(
    spark, root, atlas="4S456Parcels", sessions=None, workflows=None
) -> DataFrame:
    """Long rows of all diffusion files of the given sessions (raw ids) and workflows."""
    found = diffusion_files(list_files(spark, root, "*_parc.tsv"), atlas, workflows)
    if sessions is not None:
        found = only_sessions(found, sessions)
    return diffusion_rows(read_listed(found, root, strict=True), atlas, workflows)


def discover_workflows(spark, root) -> DataFrame:
    """Names of the workflows below ``root``: one folder is listed, whatever lies in the others."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/qsirecon-*")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    names = [s.getPath().getName() for s in found or [] if s.isDirectory()]
    return spark.createDataFrame(
        [(n.removeprefix("qsirecon-"),) for n in names if n != "qsirecon-"], "workflow string"
    )
