"""Document sources: archives, annotated XML, workbooks and ontologies.

Files are read as ``binaryFile`` rows, so that a folder of any size is split
over executors, and parsed by Arrow functions with the standard library.
"""

from __future__ import annotations

import fnmatch
import hashlib
import io
import re
import tarfile
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.operators.checks import issue


def files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "content")


def safe_path(path: Column) -> Column:
    """Relative, with forward slashes, without empty, dot or parent steps."""
    steps = F.split(path, "/")
    bad = F.exists(steps, lambda s: (s == "") | (s == ".") | (s == "..") | s.contains("\\") | s.contains("\0") | s.rlike("^[A-Za-z]:"))
    return F.coalesce((path != "") & ~bad, F.lit(False))


def _members(content: bytes) -> Iterator[tuple[str, bytes | None, int]]:
    """(path, content, size) of a zip or tar archive's files; no content for
    links and devices."""
    if zipfile.is_zipfile(io.BytesIO(content)):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for m in z.infolist():
                if not m.is_dir():
                    link = m.external_attr >> 16 & 0o170000 == 0o120000
                    yield m.filename, None if link else z.read(m), m.file_size
    else:
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for m in t:
                if not m.isdir():
                    f = t.extractfile(m) if m.isfile() else None
                    yield m.name, f.read() if f else None, m.size


def archive_members(archives: DataFrame, include: list[str] | None = None) -> DataFrame:
    """archive, path, sha256, byte_length, content, regular: the members of zip
    and tar archives (path, content) that match one of the globs, one row at a
    time."""
    schema = pa.schema([("archive", pa.string()), ("path", pa.string()), ("sha256", pa.string()), ("byte_length", pa.int64()), ("content", pa.binary()), ("regular", pa.bool_())])

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for path, body, size in _members(content):
                    if include is None or any(fnmatch.fnmatchcase(path, g) for g in include):
                        digest = None if body is None else hashlib.sha256(body).hexdigest()
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (name, path, digest, size, body, body is not None)))], schema=schema)

    kind = "archive string, path string, sha256 string, byte_length bigint, content binary, regular boolean"
    return archives.select("path", "content").mapInArrow(run, kind)


def member_issues(members: DataFrame, most: int, most_bytes: int, required: list[str]) -> DataFrame:
    """Unsafe paths, other than regular files, paths that repeat, too many or too large
    members, and required globs that match nothing."""
    one = lambda df, why: df.select(*issue("archive", F.col("path"), why))
    out = one(members.where(~safe_path(F.col("path"))), "unsafe_path").unionByName(one(members.where("not regular"), "not_a_file"))
    out = out.unionByName(one(members.groupBy("archive", F.lower("path").alias("path")).count().where("count > 1"), "repeated_path"))
    size = members.groupBy("archive").agg(F.count("*").alias("n"), F.sum("byte_length").alias("b"))
    out = out.unionByName(size.where(F.col("n") > most).select(*issue("archive", F.col("archive"), "too_many_members", F.col("n"))))
    out = out.unionByName(size.where(F.col("b") > most_bytes).select(*issue("archive", F.col("archive"), "too_large", F.col("b"))))
    for glob in required:
        hits = members.groupBy("archive").agg(F.count_if(F.col("path").rlike(glob_pattern(glob))).alias("n"))
        out = out.unionByName(hits.where("n = 0").select(*issue("archive", F.col("archive"), "required_member_missing", F.lit(glob))))
    return out


def glob_pattern(glob: str) -> str:
    """A glob as a regular expression for Java."""
    return "^" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob) + "$"


XML_KIND = (
    "path string, text string, error string, "
    "annotations array<struct<xmi_id:string,type:string,begin:int,end:int,attributes:map<string,string>>>, "
    "relations array<struct<xmi_id:string,type:string,role:string,target:string>>"
)


def _xml(content: bytes, types: set[str], relations: dict[str, list[str]], ignored: set[str]) -> dict:
    if b"<!DOCTYPE" in content or b"<!ENTITY" in content:
        return {"error": "document type or entity declared"}
    try:
        root = ET.fromstring(content)
    except ET.ParseError as error:
        return {"error": str(error)}
    text, found, links = None, [], []
    for node in root:
        kind = node.tag.rpartition("}")[2]
        attributes = {k.rpartition("}")[2]: v for k, v in node.attrib.items()}
        own = attributes.pop("id", None)
        if kind == "Sofa":
            text = attributes.get("sofaString")
        elif kind in types:
            if not (attributes.get("begin", "").isdigit() and attributes.get("end", "").isdigit()):
                return {"error": f"{kind} without begin or end"}
            span = int(attributes.pop("begin")), int(attributes.pop("end"))
            found.append({"xmi_id": own, "type": kind, "begin": span[0], "end": span[1], "attributes": [(k, v) for k, v in sorted(attributes.items()) if v]})
        elif kind in relations:
            links += [{"xmi_id": own, "type": kind, "role": role, "target": attributes[role]} for role in relations[kind] if role in attributes]
        elif kind not in ignored:
            return {"error": f"unknown element {kind}"}
    return {"text": text, "annotations": found, "relations": links, "error": None if text is not None else "no text"}


def annotated_xml(members: DataFrame, types: list[str], relations: dict[str, list[str]], ignored: list[str] = ["Token", "Sentence", "METADATA", "View", "NULL"]) -> DataFrame:
    """A row for each annotated XML file (path, content): text, annotations (in
    UTF-16 offsets) and relations, or an error. Entities are refused and an
    element of an unknown type is an error."""
    own, skip = set(types), set(ignored)
    schema = pa.schema([
        ("path", pa.string()), ("text", pa.string()), ("error", pa.string()),
        ("annotations", pa.list_(pa.struct([("xmi_id", pa.string()), ("type", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("attributes", pa.map_(pa.string(), pa.string()))]))),
        ("relations", pa.list_(pa.struct([("xmi_id", pa.string()), ("type", pa.string()), ("role", pa.string()), ("target", pa.string())]))),
    ])

    def run(batches):
        for batch in batches:
            rows = [{"path": p, **_xml(c, own, relations, skip)} for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return members.select("path", "content").mapInArrow(run, XML_KIND)


#: Attributes of METADATA by the names that an attribution has for them.
ATTRIBUTION = {"source_case_id": "docName", "author": "docAuthor", "doi": "docDOI", "url": "docUrl", "license": "docLicense"}


def _attribution(content: bytes) -> dict:
    try:
        root = ET.fromstring(_plain_xml(content))
    except (ET.ParseError, ValueError) as error:
        return {"error": str(error)}
    found = [e for e in root.iter() if e.tag.endswith("}METADATA")]
    if len(found) != 1:
        return {"error": f"{len(found)} METADATA elements"}
    if not found[0].get("docName"):
        return {"error": "METADATA without docName"}
    return {name: found[0].get(attribute, "") for name, attribute in ATTRIBUTION.items()}


def attributions(members: DataFrame) -> DataFrame:
    """A row for each annotated XML file (path, content): source_case_id,
    author, doi, url and license as its METADATA element gives them (empty where
    it does not), or an error unless there is exactly one with a name."""
    schema = pa.schema([(c, pa.string()) for c in ("path", *ATTRIBUTION, "error")])

    def run(batches):
        for batch in batches:
            rows = [{"path": p, **_attribution(c)} for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return members.select("path", "content").mapInArrow(run, ", ".join(f"{c} string" for c in schema.names))


def _sheet_rows(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row number, cells as text) of a workbook; formulas, external
    links and macros are errors."""
    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        if len(names) != len(set(names)) or any(n.startswith("/") or ".." in n.split("/") for n in names):
            raise ValueError("unsafe or repeated package member")
        if any("vbaProject" in n or n.startswith("xl/externalLinks/") for n in names):
            raise ValueError("macros or external links")
        parse = lambda n: ET.fromstring(_plain_xml(z.read(n)))
        shared = ["".join(t.text or "" for t in s.iter(f"{main}t")) for s in parse("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        targets = {r.get("Id"): r.get("Target") for r in parse("xl/_rels/workbook.xml.rels")}
        for sheet in parse("xl/workbook.xml").iter(f"{main}sheet"):
            target = targets[sheet.get(rel)]
            for row in parse(target.lstrip("/") if target.startswith("/") else f"xl/{target}").iter(f"{main}row"):
                cells: list[str | None] = []
                for c in row.iter(f"{main}c"):
                    if c.find(f"{main}f") is not None:
                        raise ValueError(f"formula in {sheet.get('name')}")
                    column = 0
                    for letter in re.match("[A-Z]+", c.get("r", "A"))[0]:
                        column = column * 26 + ord(letter) - 64
                    cells += [None] * (column - 1 - len(cells))
                    value = c.find(f"{main}v")
                    if c.get("t") == "inlineStr":
                        cells.append("".join(t.text or "" for t in c.iter(f"{main}t")))
                    else:
                        cells.append(None if value is None else shared[int(value.text)] if c.get("t") == "s" else value.text)
                yield sheet.get("name"), int(row.get("r")), cells


def _plain_xml(content: bytes) -> bytes:
    if b"<!DOCTYPE" in content or b"<!ENTITY" in content:
        raise ValueError("document type or entity declared")
    return content


def workbook_rows(books: DataFrame) -> DataFrame:
    """path, sheet, row_no, cells ARRAY<STRING>, error of workbooks (path,
    content); one row with an error for a workbook that is refused."""
    schema = pa.schema([("path", pa.string()), ("sheet", pa.string()), ("row_no", pa.int32()), ("cells", pa.list_(pa.string())), ("error", pa.string())])

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rows = [(path, *r, None) for r in _sheet_rows(content)]
                except (ValueError, KeyError, ET.ParseError, zipfile.BadZipFile) as error:
                    rows = [(path, None, None, None, f"{type(error).__name__}: {error}")]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    return books.select("path", "content").mapInArrow(run, "path string, sheet string, row_no int, cells array<string>, error string")


def sheet_table(rows: DataFrame, sheet: str, header: list[str]) -> tuple[DataFrame, DataFrame]:
    """(table, issues) of one sheet whose first row must be ``header``."""
    own = rows.where(F.col("sheet") == sheet)
    wrong = own.where((F.col("row_no") == 1) & ~F.col("cells").eqNullSafe(F.array(*map(F.lit, header))))
    table = own.where("row_no > 1").select("path", "row_no", *(F.get("cells", F.lit(i)).alias(h) for i, h in enumerate(header)))
    return table, wrong.select(*issue("sheet", F.lit(sheet), "header_differs", F.array_join("cells", "|")))


def ontology(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """terms (id, label, obsolete, alternate_ids, replaced_by, consider,
    umls_cuis, synonyms, parents), alternates (alternate, id), names (id, name),
    edges (parent, child) and issues of an OBO file, in SQL functions. Issues:
    duplicate_id and duplicate_xref, which the reference fails on, and
    malformed_xref, which it warns of; such an xref is left out."""
    text = spark.read.text(path, wholetext=True)
    stanza = F.explode(F.split(F.regexp_replace("value", r"\r\n?", "\n"), r"\n(?=\[)")).alias("stanza")
    s = text.select(stanza).where(F.startswith("stanza", F.lit("[Term]\n")))
    every = lambda pattern: F.array_distinct(F.regexp_extract_all("stanza", F.lit(r"(?m)^" + pattern), F.lit(1)))
    terms = s.select(
        F.regexp_extract("stanza", r"(?m)^id: (\S+)", 1).alias("id"), F.nullif(F.regexp_extract("stanza", r"(?m)^name: (.+)$", 1), F.lit("")).alias("label"),
        F.col("stanza").rlike(r"(?m)^is_obsolete: true").alias("obsolete"), every(r"alt_id: (\S+)").alias("alternate_ids"),
        every(r"replaced_by: (\S+)").alias("replaced_by"), every(r"consider: (\S+)").alias("consider"), every(r"xref: UMLS:(C[0-9]{7})$").alias("umls_cuis"),
        F.transform(every(r'synonym: "((?:[^"\\]|\\.)*)"'), lambda v: F.replace(v, F.lit('\\"'), F.lit('"'))).alias("synonyms"), every(r"is_a: (\S+)").alias("parents"),
    )
    primary = terms.where("obsolete").select(F.col("id").alias("alternate"))
    alternates = terms.select(F.explode("alternate_ids").alias("alternate"), "id").join(primary, "alternate", "left_anti")
    names = terms.where("label is not null").select("id", F.explode(F.concat(F.array("label"), "synonyms")).alias("name"))
    edges = terms.select(F.explode("parents").alias("parent"), F.col("id").alias("child"))
    twice = terms.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(*issue("ontology", F.col("id"), "duplicate_id", F.col("n")))
    xref = s.select(F.regexp_extract("stanza", r"(?m)^id: (\S+)", 1).alias("id"), F.explode(F.regexp_extract_all("stanza", F.lit(r"(?m)^xref: UMLS:(.*)$"), F.lit(1))).alias("value"))
    good = F.col("value").rlike(r"^C[0-9]{7}\z")
    # within one stanza: a repeated id has an issue of its own
    same = s.select(F.regexp_extract("stanza", r"(?m)^id: (\S+)", 1).alias("id"), F.regexp_extract_all("stanza", F.lit(r"(?m)^xref: UMLS:(C[0-9]{7})$"), F.lit(1)).alias("v"))
    same = same.select("id", F.explode(F.filter(F.array_distinct("v"), lambda c: F.size(F.filter("v", lambda o: o == c)) > 1)).alias("value"))
    issues = twice.unionByName(same.select(*issue("ontology", F.col("id"), "duplicate_xref", F.col("value"))))
    issues = issues.unionByName(xref.where(~good).select(*issue("ontology", F.col("id"), "malformed_xref", F.col("value"))))
    return {"terms": terms, "alternates": alternates, "names": names, "edges": edges, "issues": issues}


def html_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles and comments go, block ends are
    line feeds, the common entities are resolved."""
    out = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?(</\1\s*>|$)", "")
    out = F.regexp_replace(out, r"(?i)<(br|/p|/div|/h[1-6]|/li|/tr)\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", "")
    for entity, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(c))
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\s*\n\s*", "\n"))
