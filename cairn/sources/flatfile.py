r"""Flat files of sequence records as twelve relations.

A file is split at its `//` lines into one row per record by Spark's text reader.  A small helper
parses one record's block to a nested struct, in Arrow batches; every relation is then a projection
of that one table by `posexplode`, with 1-based ordinals in source order.  Nothing is gathered: files
of any number of records are read where they lie.

All cells are text, absent ones empty; `typed` gives the typed tier, where ordinals, lengths and
coordinates are bigint and empty text is null.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Relations and their columns, as their readers know them.
#: relations, their columns, and which of them are numbers
RELATIONS = {
    "records": ("record_id", "record_ordinal", "accession", "version", "locus_name", "definition", "organism_name", "ncbi_taxid", "molecule_type", "topology", "division", "record_date", "sequence_length_nt", "sequence_sha256"),
    "record_keywords": ("record_id", "keyword_ordinal", "keyword"),
    "record_taxonomy": ("record_id", "lineage_ordinal", "taxon_name"),
    "record_xrefs": ("record_id", "xref_ordinal", "database_name", "identifier"),
    "record_accessions": ("record_id", "accession_ordinal", "accession", "accession_role"),
    "features": ("feature_id", "record_id", "feature_ordinal", "feature_key", "location_parsed", "location_operator"),
    "feature_location_parts": ("feature_id", "part_ordinal", "start_1based", "end_1based_inclusive", "strand", "start_position_class", "end_position_class", "remote_accession"),
    "feature_qualifiers": ("feature_id", "qualifier_ordinal", "qualifier_name", "value_ordinal", "qualifier_value"),
    "references": ("reference_id", "record_id", "reference_ordinal", "title", "journal_raw", "authors_raw", "pubmed_id", "medline_id", "consortium", "reference_location", "remark"),
    "reference_authors": ("reference_id", "author_ordinal", "author_raw"),
    "comments": ("comment_id", "record_id", "comment_ordinal", "comment_type", "comment_text"),
    "structured_comment_fields": ("comment_id", "field_ordinal", "field_name", "field_value"),
}
NUMBERS = frozenset("record_ordinal sequence_length_nt keyword_ordinal lineage_ordinal xref_ordinal accession_ordinal feature_ordinal part_ordinal start_1based end_1based_inclusive qualifier_ordinal value_ordinal reference_ordinal author_ordinal comment_ordinal field_ordinal".split())

_PART = "struct<start:string,end:string,strand:string,start_class:string,end_class:string,remote:string>"
_QUALIFIER = "struct<name:string,values:array<string>>"
PARSED = (
    "record_id string, offset long, locus_name string, molecule_type string, topology string, division string, record_date string, definition string, accessions array<string>, organism_name string, lineage array<string>, keywords array<string>, xrefs array<string>, "
    f"features array<struct<key:string,location:string,operator:string,parts:array<{_PART}>,qualifiers:array<{_QUALIFIER}>>>, "
    "refs array<struct<location:string,authors:string,consortium:string,title:string,journal:string,pubmed:string,medline:string,remark:string>>, comment string, structured array<struct<name:string,value:string>>, sequence string"
)


def _flow(lines: list[str]) -> str:
    return " ".join(" ".join(x.split()) for x in lines if x.strip())


def _sections(block: str) -> list[tuple[str, list[str]]]:
    """(keyword, lines) in order; sub-keywords keep their indent as a leading space."""
    out: list[tuple[str, list[str]]] = []
    for line in block.split("\n"):
        word = line[:12].strip()
        if out and out[-1][0] == "FEATURES" and line.startswith(" "):
            out[-1][1].append(line)
        elif word and (line[0] != " " or re.match(r" {2,3}[A-Z]", line)) and not word[0].isdigit():
            out.append(((" " if line[0] == " " else "") + word, [line[12:]]))
        elif out:
            out[-1][1].append(line[12:] if out[-1][0] != "ORIGIN" else line)
    return out


def _parts(location: str, strand: str = "+") -> list[tuple]:
    """The spans of a location, innermost first; a complement turns the strand and the order."""
    m = re.fullmatch(r"(complement|join|order)\((.*)\)", location)
    if m:
        depth, inner = 0, [""]
        for c in m[2]:
            depth += (c == "(") - (c == ")")
            inner = [*inner, ""] if c == "," and not depth else [*inner[:-1], inner[-1] + c]
        if m[1] == "complement":
            return _parts(m[2], "-" if strand == "+" else "+")[::-1]
        return [p for x in inner for p in _parts(x, strand)]
    remote, _, span = location.rpartition(":")
    a, _, b = span.replace("^", "..").partition("..")
    name = lambda x: "before" if x[:1] == "<" else "after" if x[:1] == ">" else "exact"
    b = b or a
    return [(a.strip("<>"), b.strip("<>"), strand, name(a), name(b), remote)]


def _features(lines: list[str]) -> list[dict]:
    out: list[dict] = []
    for line in lines:
        key, rest = line[:21].strip(), line[21:].rstrip()
        if key:
            out.append({"key": key, "location": rest, "raw": []})
        elif not out:
            continue
        elif rest.startswith("/"):
            out[-1]["raw"].append(rest[1:])
        elif out[-1]["raw"]:
            glue = "" if out[-1]["raw"][-1].startswith("translation=") else " "
            out[-1]["raw"][-1] += glue + rest
        else:
            out[-1]["location"] += rest.strip()
    for f in out:
        values: dict[str, list[str]] = {}
        for q in f.pop("raw"):
            name, _, value = q.partition("=")
            values.setdefault(name, []).append(value.removeprefix('"').removesuffix('"').replace('""', '"'))
        m = re.search(r"\b(join|order)\(", f["location"])
        f |= {"operator": m[1] if m else "", "parts": _parts(f["location"]), "qualifiers": list(values.items())}
    return out


def parse_record(block: str) -> dict | None:
    """One record's block as the nested struct PARSED; None where there is no LOCUS line."""
    sections = _sections(block.strip("\n"))
    if not sections or sections[0][0] != "LOCUS":
        return None
    first: dict[str, list[str]] = {}
    for key, lines in sections:
        first.setdefault(key, lines)
    locus = first["LOCUS"][0].split()
    known = locus[3:] if len(locus) > 3 else []
    organism = first.get(" ORGANISM", [""])
    refs: list[dict] = []
    fields = {" AUTHORS": "authors", " CONSRTM": "consortium", " TITLE": "title", " JOURNAL": "journal", " PUBMED": "pubmed", " MEDLINE": "medline", " REMARK": "remark"}
    for key, lines in sections:
        if key == "REFERENCE":
            m = re.search(r"\((.*)\)", _flow(lines))
            refs.append({"location": m[1] if m else ""} | dict.fromkeys(fields.values(), ""))
        elif key in fields and refs:
            refs[-1][fields[key]] = _flow(lines)
    comment, structured, inside = [], [], False
    for line in first.get("COMMENT", []):
        if line.startswith("##"):
            inside = line.rstrip().endswith("START##")
        elif inside and "::" in line:
            name, _, value = line.partition("::")
            structured.append((name.strip(), value.strip()))
        elif inside and structured:
            structured[-1] = (structured[-1][0], f"{structured[-1][1]} {line.strip()}".strip())
        else:
            comment.append(line)
    split = lambda text, mark: [x for x in (y.strip() for y in text.rstrip(".").split(mark)) if x]
    version = _flow(first.get("VERSION", [""])).split(" ")[0]
    accessions = _flow(first.get("ACCESSION", [""])).split()
    return {
        "record_id": version or (accessions or [""])[0],
        "locus_name": locus[0] if locus else "",
        "molecule_type": known[0] if known else "",
        "topology": next((x for x in known if x in ("linear", "circular")), ""),
        "division": known[-2] if len(known) > 2 else "",
        "record_date": known[-1] if len(known) > 1 else "",
        "definition": _flow(first.get("DEFINITION", [])).removesuffix("."),
        "accessions": accessions,
        "organism_name": " ".join(organism[0].split()),
        "lineage": split(_flow(organism[1:]), ";"),
        "keywords": split(_flow(first.get("KEYWORDS", [])), ";"),
        "xrefs": [" ".join(x.split()) for x in first.get("DBLINK", []) if x.strip()],
        "features": _features(first.get("FEATURES", [""])[1:]),
        "refs": refs,
        "comment": _flow(comment),
        "structured": structured,
        "sequence": re.sub(r"[^A-Za-z*-]", "", "".join(first.get("ORIGIN", []))).upper(),
    }


def parsed_blocks(blocks: DataFrame) -> DataFrame:
    """The nested struct of each record of `blocks` (value, offset), `offset` being its place in source order."""
    names = [x.split(" ")[0] for x in re.split(r", (?=[a-z_]+ (?:string|long|array))", PARSED)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [r | {"offset": o} for r, o in ((parse_record(v), o) for v, o in zip(pdf.value, pdf.offset, strict=True)) if r]
            yield pd.DataFrame(rows, columns=names)

    return blocks.select("value", "offset").mapInPandas(run, PARSED)


def parsed_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files at `path`."""
    return parsed_blocks(spark.read.option("lineSep", "\n//").text(path).withColumn("offset", F.monotonically_increasing_id()))


def records_in_memory(spark: SparkSession, records: Iterable[str]) -> DataFrame:
    """One row per record of texts that are at hand, in their order."""
    return parsed_blocks(spark.createDataFrame([(text.removesuffix("//\n").removesuffix("//"), i) for i, text in enumerate(records)], "value string, offset long"))


def relations(parsed: DataFrame) -> dict[str, DataFrame]:
    """The twelve relations of `parsed`, which should be saved or cached; cells are text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    sub = lambda kind, n="n": F.concat("record_id", F.lit(f":{kind}"), (F.col(n) + 1).cast("string"))
    each = lambda column, name="x", df=parsed, keep=("record_id",): df.select(*keep, F.posexplode(column).alias("n", name))
    ordinal = (F.col("n") + 1).cast("string")
    # ordinals of records without a global sort: rows before the partition, and within it
    order = parsed.select("record_id", "offset").withColumn("part", F.shiftright("offset", 33))
    sizes = order.groupBy("part").agg(F.count("*").alias("rows"))
    earlier = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(earlier, F.lit(0)).alias("before"))
    place = order.join(starts, "part").select("record_id", (F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("offset"))).alias("record_ordinal"))
    source = F.filter("features", lambda f: f["key"] == "source")[0]
    taxa = F.flatten(F.transform(F.filter(source["qualifiers"], lambda q: q["name"] == "db_xref"), lambda q: q["values"]))
    taxid = F.get(F.filter(taxa, lambda x: x.startswith("taxon:")), F.lit(0))
    rows = parsed.join(place, "record_id").withColumn("ncbi_taxid", F.substring_index(taxid, ":", -1)).withColumn("accession", F.get("accessions", F.lit(0)))
    rows = rows.withColumn("version", F.col("record_id")).withColumn("sequence_length_nt", F.length("sequence")).withColumn("sequence_sha256", F.sha2("sequence", 256))
    features = each("features", "f").select("record_id", sub("F").alias("feature_id"), ordinal.alias("feature_ordinal"), "f")
    refs = each("refs", "r").select("record_id", sub("R").alias("reference_id"), ordinal.alias("reference_ordinal"), "r")
    qualifiers = each("f.qualifiers", "q", features, ("feature_id",)).withColumn("qualifier_ordinal", ordinal)
    both = parsed.select("record_id", F.array(F.struct(F.lit("free").alias("kind"), F.lit("C").alias("mark"), F.col("comment").alias("text"), F.col("comment") != ""), F.struct(F.lit("structured").alias("kind"), F.lit("SC").alias("mark"), F.lit("").alias("text"), F.size("structured") > 0)).alias("all"))
    comments = both.select("record_id", F.posexplode(F.filter("all", lambda c: c["col4"])).alias("n", "c"))
    author = F.filter(F.transform(F.split(F.regexp_replace("r.authors", " and ", ", "), r"(?<=\.),\s*"), lambda a: F.trim(a)), lambda a: a != "")
    out = {
        "records": rows,
        "record_keywords": each("keywords").select("record_id", ordinal.alias("keyword_ordinal"), F.col("x").alias("keyword")),
        "record_taxonomy": each("lineage").select("record_id", ordinal.alias("lineage_ordinal"), F.col("x").alias("taxon_name")),
        "record_xrefs": each("xrefs").select("record_id", ordinal.alias("xref_ordinal"), F.when(F.instr("x", ":") > 0, F.trim(F.substring_index("x", ":", 1))).otherwise("").alias("database_name"), F.trim(F.when(F.instr("x", ":") > 0, F.substr("x", F.instr("x", ":") + 1)).otherwise(F.col("x"))).alias("identifier")),
        "record_accessions": each("accessions").select("record_id", ordinal.alias("accession_ordinal"), F.col("x").alias("accession"), F.when(F.col("n") == 0, "primary").otherwise("secondary").alias("accession_role")),
        "features": features.select("feature_id", "record_id", "feature_ordinal", F.col("f.key").alias("feature_key"), F.col("f.location").alias("location_parsed"), F.col("f.operator").alias("location_operator")),
        "feature_location_parts": each("f.parts", "p", features, ("feature_id",)).select("feature_id", ordinal.alias("part_ordinal"), F.col("p.start").alias("start_1based"), F.col("p.end").alias("end_1based_inclusive"), F.col("p.strand").alias("strand"), F.col("p.start_class").alias("start_position_class"), F.col("p.end_class").alias("end_position_class"), F.col("p.remote").alias("remote_accession")),
        "feature_qualifiers": qualifiers.select("feature_id", "qualifier_ordinal", F.col("q.name").alias("qualifier_name"), F.posexplode("q.values").alias("n", "qualifier_value")).withColumn("value_ordinal", ordinal),
        "references": refs.select("reference_id", "record_id", "reference_ordinal", F.col("r.title").alias("title"), F.col("r.journal").alias("journal_raw"), F.col("r.authors").alias("authors_raw"), F.col("r.pubmed").alias("pubmed_id"), F.col("r.medline").alias("medline_id"), F.col("r.consortium").alias("consortium"), F.col("r.location").alias("reference_location"), F.col("r.remark").alias("remark")),
        "reference_authors": refs.select("reference_id", F.posexplode(author).alias("n", "author_raw")).withColumn("author_ordinal", ordinal),
        "comments": comments.select(F.concat("record_id", F.lit(":"), "c.mark", F.lit("1")).alias("comment_id"), "record_id", ordinal.alias("comment_ordinal"), F.col("c.kind").alias("comment_type"), F.col("c.text").alias("comment_text")),
        "structured_comment_fields": each("structured").select(F.concat("record_id", F.lit(":SC1")).alias("comment_id"), ordinal.alias("field_ordinal"), F.col("x.name").alias("field_name"), F.col("x.value").alias("field_value")),
    }
    return {name: df.select(*[text(c).alias(c) for c in RELATIONS[name]]) for name, df in out.items()}


def sequences(parsed: DataFrame) -> DataFrame:
    """(version, sequence), upper case."""
    return parsed.select(F.col("record_id").alias("version"), "sequence")


def typed(df: DataFrame) -> DataFrame:
    """The typed tier: numbers are bigint, empty text is null."""
    return df.select(*[F.nullif(F.col(c), F.lit("")).cast("long" if c in NUMBERS else "string").alias(c) for c in df.columns])


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
