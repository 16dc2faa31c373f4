"""Queries of the rule language and of XML documents. Their SQL states the same from the columns that the XML was built from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import documents as d
from ..operators import rules as r
from .registry import Tables, query

KEY = ["volume", "file"]


def jhove(t: Tables) -> DataFrame:
    """Technical metadata as XML, malformed for one volume in 97."""
    tag = lambda name, v: F.coalesce(F.concat(F.lit(f"<m:{name}>"), v, F.lit(f"</m:{name}>")), F.lit(""))
    c = F.col
    res = tag("xRes", c("resolution"))
    mix = F.concat(F.lit("<m:mix>"), res, F.when(c("n_resolution") == 2, res).otherwise(""), tag("width", c("width")), tag("copyOfWidth", F.when(c("volume") % 7 == 0, "1").otherwise(c("width"))), tag("height", c("height")), F.lit('<m:bits perSample="'), "bits", F.lit('"/></m:mix>'))
    xml = F.concat(F.lit('<j:repInfo xmlns:j="urn:j" xmlns:m="urn:m">'), F.lit("<j:format>"), "format", F.lit("</j:format><j:status>"), "status", F.lit("</j:status>"), mix, F.when(c("volume") % 97 == 0, "").otherwise("</j:repInfo>"))
    return spread(t.tech_metadata).select(*KEY, xml.alias("xml"))


def spread(rows: DataFrame) -> DataFrame:
    """Rows on all cores: the test table is one row group, which one task alone would turn into XML and parse."""
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)


RES = "try_cast(regexp_extract(resolution, '^([0-9]+)', 1) as bigint)"
OK = {
    "format": "format = 'TIFF'", "status": "status = 'Well-Formed and valid'", "resolution": f"resolution is not null and n_resolution = 1 and {RES} >= 600", "bits": "bits in ('1', '2')",
    "dimensions": "cast(width as int) > 0 and cast(height as int) > 0", "same_width": "volume % 7 > 0 or width = '1'", "height_range": "cast(height as int) between 0 and 1600",
}
VERDICTS = " union all ".join(f"select volume, file, '{k}' as rule, coalesce(volume % 97 > 0 and ({v}), false) as ok from tech_metadata" for k, v in OK.items())


@query("rule_results", VERDICTS, "tech_metadata")
def rule_results(t: Tables) -> DataFrame:
    return r.verdicts(r.check(jhove(t), "xml", r.TIFF, r.tiff_rules()), KEY)


@query("rule_errors", """
  with bad as (select *, volume % 97 = 0 as broken from tech_metadata), rules as (select unnest(['format', 'status', 'resolution', 'bits', 'dimensions', 'same_width', 'height_range']) as rule)
  select volume, file, rule, 'BadFile' as code, 'xml' as field, cast(null as varchar) as actual from bad cross join rules where broken
  union all select volume, file, 'format', 'BadValue', 'format', format from bad where not broken and format <> 'TIFF'
  union all select volume, file, 'status', 'BadValue', 'status', status from bad where not broken and status <> 'Well-Formed and valid'
  union all select volume, file, 'resolution', 'MissingField', 'xRes', '0' from bad where not broken and resolution is null
  union all select volume, file, 'resolution', 'BadField', 'xRes', '2' from bad where not broken and resolution is not null and n_resolution = 2
  union all select volume, file, 'resolution', 'BadValue', 'xRes', resolution from bad where not broken and resolution = '300' and n_resolution = 1
  union all select volume, file, 'bits', 'BadValue', 'bitsPerSample', bits from bad where not broken and bits = '8'
  union all select volume, file, 'dimensions', 'BadValue', 'width', width from bad where not broken and cast(width as int) <= 0
  union all select volume, file, 'dimensions', 'BadValue', 'height', height from bad where not broken and cast(height as int) <= 0
  union all select volume, file, 'same_width', 'NotEqualValues', 'width', width from bad where not broken and volume % 7 = 0 and width <> '1'
  union all select volume, file, 'height_range', 'BadValue', 'height', height from bad where not broken and cast(height as int) > 1600""", "tech_metadata")  # fmt: skip
def rule_errors(t: Tables) -> DataFrame:
    return r.errors(r.check(jhove(t), "xml", r.TIFF, r.tiff_rules()), KEY).drop("expected")


@query("rule_overrides", " union all ".join(
    f"select volume, file, '{k}' as rule, coalesce(volume % 97 > 0 and ({v}), false) as ok from tech_metadata" for k, v in {"format": OK["format"], "resolution": f"resolution is not null and n_resolution = 1 and {RES} >= 290"}.items()), "tech_metadata")
def rule_overrides(t: Tables) -> DataFrame:
    """A package type's changes: a lower resolution will do, and all but two rules are off."""
    off = {k: None for k in OK if k not in ("format", "resolution")}
    rules = r.merged(r.tiff_rules(), off | {"resolution": r.v_ge("mix", "xRes", 290)})
    return r.verdicts(r.check(jhove(t), "xml", r.TIFF, rules), KEY)


@query("cardinality_errors", "select volume, file, case when volume % 97 = 0 then 'BadFile' when resolution is null then 'MissingField' when n_resolution = 2 then 'BadField' else 'ok' end as status from tech_metadata", "tech_metadata")
def cardinality_errors(t: Tables) -> DataFrame:
    checked = r.check(jhove(t), "xml", r.TIFF, {"one": r.v_exists("mix", "xRes")})
    return checked.select(*KEY, F.coalesce(F.try_element_at(F.col("results")[0]["errors"], F.lit(1))["code"], F.lit("ok")).alias("status"))


def prop(name: str, *inside: Column) -> Column:
    return F.concat(F.lit(f"<property><name>{name}</name><values>"), *inside, F.lit("</values></property>"))


def tag(path: str, value: Column) -> Column:
    """A value in nested elements; none for null."""
    names = path.split("/")
    return F.coalesce(F.concat(F.lit("".join(f"<{n}>" for n in names)), value, F.lit("".join(f"</{n}>" for n in reversed(names)))), F.lit(""))


def report(head: dict[str, Column], body: Column) -> Column:
    top = [tag(r.REP_INFO[k], v) for k, v in head.items()]
    return F.concat(F.lit('<?xml version="1.0"?>\n<jhove xmlns="urn:j" xmlns:mix="urn:m"><repInfo uri="x">'), *top, F.lit("<properties>"), body, F.lit("</properties></repInfo></jhove>"))


def packet(values: dict[str, Column]) -> Column:
    inside = [tag(r.XMP[k] if isinstance(r.XMP[k], str) else r.XMP[k][0], v) for k, v in values.items()]
    return F.concat(F.lit('<?xpacket begin="" id="x"?><x:xmpmeta xmlns:x="urn:x" xmlns:rdf="urn:r"><rdf:RDF><rdf:Description>'), *inside, F.lit("</rdf:Description></rdf:RDF></x:xmpmeta>"))


def mixed(values: dict[str, Column]) -> Column:
    inside = F.concat(*(tag(r.MIX[k], v) for k, v in values.items()))
    return prop("NisoImageMetadata", F.lit("<value><mix:mix>"), inside, F.lit("</mix:mix></value>"))


def tiff_reports(t: Tables) -> DataFrame:
    """Reports whose XMP agrees with the header (volumes of remainder 0 and 1 by 5), has another width (2), can't be parsed (3), is not there (4), or there twice (0 by 45)."""
    c, k = F.col, F.col("volume") % 5
    own = {
        "compression": F.lit("Group 4 Fax"), "colorSpace": F.lit("WhiteIsZero"), "width": c("width"), "length": c("height"), "orientation": F.lit("normal*"), "artist": c("status"), "dateTime": F.lit("2024-01-02T03:04:05"),
        "xRes_numerator": F.regexp_extract("resolution", "^([0-9]+)", 1), "xRes_denominator": F.nullif(F.regexp_extract("resolution", "/([0-9]+)$", 1), F.lit("")), "yRes_numerator": F.regexp_extract("resolution", "^([0-9]+)", 1), "resUnit": F.lit("in."), "bitsPerSample": c("bits"), "samplesPerPixel": F.lit("1"),
    }
    other = F.when(k == 2, F.concat("width", F.lit("9"))).otherwise(c("width"))
    said = {"width": other, "length": c("height"), "bitsPerSample": c("bits"), "compression": F.lit("4"), "colorSpace": F.lit("0"), "orientation": F.lit("1"), "samplesPerPixel": F.lit("1"), "xRes": F.lit("600/1"), "yRes": F.lit("600/1"), "resUnit": F.lit("2"), "dateTime": F.lit("2024-01-02T03:04:05+01:00"), "artist": c("status"), "make": F.lit("M"), "model": F.when(k == 0, "X"), "documentName": c("file")}
    text = F.when(k == 3, F.substring(packet(said), 1, 200)).otherwise(packet(said))
    shown = F.concat(F.lit("<value>"), F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</value>"))
    xmp = F.when(k == 4, "").otherwise(prop("XMP", shown, F.when(c("volume") % 45 == 0, shown).otherwise("")))
    ifd = prop("TIFFMetadata", prop("IFDs", prop("IFD", prop("DocumentName", F.lit("<value>"), c("file"), F.lit("</value>")), xmp, mixed(own))))
    head = {"format": c("format"), "status": c("status"), "module": F.lit("TIFF-hul"), "mimeType": F.lit("image/tiff")}
    return spread(t.tech_metadata).select(*KEY, report(head, ifd).alias("xml"))


@query("tiff_report_rules", """
  with x as (select *, volume % 5 as k, volume % 45 = 0 as twice, try_cast(regexp_extract(resolution, '^([0-9]+)', 1) as int) = 600 and resolution is not null as dense from tech_metadata),
  packet as (select *, case when k = 4 then 'none' when twice then 'twice' when k = 3 then 'broken' else 'read' end as xmp from x)
  select volume, file, r.rule, case r.rule
      when 'format' then format = 'TIFF' when 'status' then status = 'Well-Formed and valid' when 'resolution' then dense when 'bits_per_sample' then bits = '1'
      when 'dimensions' then cast(height as int) > 0 and cast(width as int) > 0 when 'xmp' then xmp = 'none' or (xmp = 'read' and k <> 2 and dense) when 'camera' then xmp = 'none' or (xmp = 'read' and k = 0) else true end as ok
  from packet cross join (select unnest(['format', 'status', 'module', 'mime_type', 'compression', 'colorspace', 'orientation', 'resolution', 'resolution_unit', 'bits_per_sample', 'samples_per_pixel', 'dimensions', 'extract_info', 'xmp', 'camera']) as rule) r""", "tech_metadata")  # fmt: skip
def tiff_report_rules(t: Tables) -> DataFrame:
    """All rules for TIFF images, those on the XMP packet within the report included."""
    return r.verdicts(r.check(tiff_reports(t), "xml", r.TIFF_REPORT, r.tiff_report_rules()), KEY)


@query("xmp_agreement", """
  with x as (select *, case when volume % 45 = 0 then 'twice' when volume % 5 = 2 then 'other' when volume % 5 = 3 then 'broken' when volume % 5 = 4 then 'absent' else 'agree' end as k from tech_metadata)
  select volume, file, case when k in ('absent', 'agree') then k else 'differ' end as status, case k when 'other' then 'NotEqualValues' when 'twice' then 'BadField' when 'broken' then 'BadField' end as code,
    case k when 'other' then 'width' when 'twice' then 'xmp' when 'broken' then 'xmp' end as field, case k when 'other' then width when 'twice' then '2' when 'broken' then '0' end as actual from x""", "tech_metadata")  # fmt: skip
def xmp_agreement(t: Tables) -> DataFrame:
    """Whether the width outside and inside the packet is the same, and if not, why."""
    rule = r.v_if_packet("xmp", r.v_same("mix", "width", "xmp", "width"))
    asked = r.TIFF_REPORT.only(("tiffMeta", "xmp"), ("mix", "width"), ("xmp", "width"))
    read = asked.read(tiff_reports(t), "xml").select(*KEY, (F.col("`p:xmp`") == 0).alias("absent"), rule.alias("errors"))
    first = F.try_element_at("errors", F.lit(1))
    status = F.when(F.col("absent"), "absent").when(F.size("errors") == 0, "agree").otherwise("differ")
    return read.select(*KEY, status.alias("status"), first["code"].alias("code"), first["field"].alias("field"), first["actual"].alias("actual"))


def jp2_reports(t: Tables) -> DataFrame:
    """Reports on grey and colour images of parts, with no XMP box (p_size of remainder 0 by 7), two (1), one with other sizes (2), or one that agrees."""
    c, k = F.col, F.col("p_size") % 7
    colour = c("p_partkey") % 2 == 1
    n, depth = F.when(colour, "3").otherwise("1"), F.when(colour, F.lit("8</li><li>8</li><li>8")).otherwise("8")
    size = c("p_size").cast("string")
    said = {"width": F.when(k == 2, "1").otherwise(size), "length": size, "bitsPerSample": depth, "compression": F.lit("34712"), "colorSpace": F.when(colour, "2").otherwise("1"), "orientation": F.lit("1"), "samplesPerPixel": n, "xRes": F.concat(c("p_size") * 10, F.lit("/1")), "yRes": F.concat(c("p_size") * 10, F.lit("/1")), "resUnit": F.lit("2"), "dateTime": F.lit("2024"), "artist": c("p_brand"), "make": F.lit("M"), "model": F.lit("X"), "documentName": c("p_name")}
    value = lambda x: F.concat(F.lit("<value>"), x.cast("string"), F.lit("</value>"))
    data = F.array_join(F.transform(F.split(packet(said), ""), lambda ch: value(F.ascii(ch))), "")
    box = lambda ids: prop("UUIDBox", prop("UUID", *(F.lit(f"<value>{x}</value>") for x in ids)), prop("Data", c("data")))
    boxes = prop("UUIDs", F.when(k == 0, "").otherwise(box(r.XMP_BOX)), box([7] * 16), F.when(k == 1, box(r.XMP_BOX)).otherwise(""))
    one = lambda name, v: prop(name, value(v))
    own = {"compression": F.lit("JPEG2000 Lossy"), "width": size, "length": size, "bitsPerSample": F.when(colour, F.lit("8</bitsPerSampleValue><bitsPerSampleValue>8</bitsPerSampleValue><bitsPerSampleValue>8")).otherwise("8"), "samplesPerPixel": n}
    coding = prop("CodingStyleDefault", one("NumberOfLayers", F.lit("1")), one("NumberDecompositionLevels", c("p_partkey") % 9), one("Transformation", F.lit("0")))
    spec = prop("ColorSpecs", prop("ColorSpec", one("EnumCS", F.when(colour, "sRGB").otherwise("Greyscale"))))
    meta = prop("JPEG2000Metadata", one("Brand", F.lit("jp2 ")), one("MinorVersion", F.lit("0")), one("Compatibility", F.lit("jp2 ")), spec, boxes, prop("Codestreams", prop("Codestream", coding, mixed(own))))
    head = {"format": F.lit("JPEG 2000"), "status": F.lit("Well-Formed and valid"), "module": F.lit("JPEG2000-hul"), "mimeType": F.lit("image/jp2")}
    # the bytes are a column of their own, so that they are made once for all boxes
    return spread(t.part).withColumn("data", data).select("p_partkey", report(head, meta).alias("xml"))


@query("jp2_report_rules", """
  with x as (select *, p_size % 7 as k, p_size % 7 > 1 as one from part)
  select p_partkey, r.rule, case r.rule when 'decomposition_levels' then p_partkey % 9 between 5 and 32 when 'resolution' then one and p_size * 10 >= 300 when 'dimensions' then one and k <> 2 and p_size > 0
      when 'compression' then one when 'orientation' then one when 'resolution_unit' then one when 'colorspace' then one when 'extract_info' then one when 'camera' then one else true end as ok
  from x cross join (select unnest(['format', 'status', 'module', 'mime_type', 'brand', 'minor_version', 'compatibility', 'compression', 'orientation', 'resolution_unit', 'resolution', 'layers', 'decomposition_levels', 'transformation', 'colorspace', 'dimensions', 'extract_info', 'camera']) as rule) r""")  # fmt: skip
def jp2_report_rules(t: Tables) -> DataFrame:
    """All rules for JP2 images; the packet is put together from the bytes that the report lists."""
    return r.verdicts(r.check(jp2_reports(t), "xml", r.JP2_REPORT, r.jp2_report_rules()), ["p_partkey"])


def volume_mets(t: Tables) -> DataFrame:
    use = F.when(F.col("ext").isin("jp2", "tif"), "image").when(F.col("ext") == "txt", "ocr").otherwise("coordOCR")
    return d.mets(d.with_ids(t.volume_files.withColumn("use", use)))


@query("mets_checksums", "select volume, file as href, md5sum from volume_files", "volume_files")
def mets_checksums(t: Tables) -> DataFrame:
    return d.mets_files(volume_mets(t)).select("volume", "href", "md5sum")


@query("filetype_histogram", "select ext, count(*) as n, count(distinct volume) as volumes from volume_files group by ext", "volume_files")
def filetype_histogram(t: Tables) -> DataFrame:
    files = d.mets_files(volume_mets(t))
    return files.groupBy(F.regexp_extract("href", r"\.(\w+)$", 1).alias("ext")).agg(F.count("*").alias("n"), F.count_distinct("volume").alias("volumes"))


@query("mets_facts", """
  select volume, concat('filetype ', ext) as key, count(*) as value from volume_files group by 1, 2
  union all select volume, 'image bytes', cast(sum(size) as bigint) from volume_files where ext in ('jp2', 'tif') group by volume
  union all select volume, 'pages', count(distinct page) from volume_files group by volume""", "volume_files")  # fmt: skip
def mets_facts(t: Tables) -> DataFrame:
    return d.facts(volume_mets(t))


def audited_mets(t: Tables) -> DataFrame:
    """A METS of each volume with its files, pages, events and records; every 97th is cut short."""
    c, v = F.col, F.col("volume")
    files = t.volume_files.withColumn("use", F.when(c("ext").isin("jp2", "tif"), "image").otherwise("ocr"))
    file = F.concat(F.lit("<M:file"), d.attribute("SIZE", c("size")), F.lit("><M:FLocat"), d.attribute("x:href", c("file")), F.lit("/></M:file>"))
    of = lambda use: F.array_join(F.array_sort(F.collect_list(F.when(c("use") == use, file))), "")
    page = F.concat(F.lit('<M:div TYPE="page"'), F.when(c("page") % 4 == 0, ' LABEL="tag"').otherwise(""), d.attribute("ORDER", c("page")), F.lit("/>"))
    parts = files.groupBy("volume").agg(of("image").alias("image"), of("ocr").alias("ocr"), F.array_join(F.array_sort(F.collect_set(page)), "").alias("pages"))
    agent = lambda kind, value, role: F.concat(F.lit(f"<linkingAgentIdentifier><linkingAgentIdentifierType>{kind}</linkingAgentIdentifierType><linkingAgentIdentifierValue>"), value, F.lit(f"</linkingAgentIdentifierValue><linkingAgentRole>{role}</linkingAgentRole></linkingAgentIdentifier>"))
    tool = F.when(c("origin") == 0, agent("tool", F.lit("t"), "software")).otherwise("")
    event = F.concat(F.lit("<event><eventIdentifier><eventIdentifierType>"), F.when(c("origin") < 2, "UUID").otherwise("old"), F.lit("</eventIdentifierType></eventIdentifier>"), tag("eventType", c("eventtype")), tag("eventDateTime", c("event_id").cast("string")), tool, agent("code", F.concat(F.lit("agent"), c("origin")), "Executor"), F.lit("</event>"))
    events = t.premis_events.filter("volume % 4 <> 1").groupBy("volume").agg(F.array_join(F.array_sort(F.collect_list(event)), "").alias("events"))
    joined = parts.join(events, "volume", "left")
    inside = F.when(v % 4 == 0, c("events")).otherwise(F.concat(F.lit("<premis>"), "events", F.lit("</premis>")))
    premis = F.coalesce(F.concat(F.lit('<M:amdSec><M:digiprovMD><M:mdWrap MDTYPE="PREMIS"><M:xmlData>'), inside, F.lit("</M:xmlData></M:mdWrap></M:digiprovMD></M:amdSec>")), F.lit(""))
    marc = F.when(v % 3 == 0, '<M:dmdSec><M:mdWrap LABEL="bib" MDTYPE="MARC"><M:xmlData><record><leader>x</leader></record></M:xmlData></M:mdWrap></M:dmdSec>').when(v % 3 == 1, '<M:dmdSec><M:mdRef MDTYPE="OTHER" OTHERMDTYPE="Item" LABEL=""/></M:dmdSec>').otherwise("")
    sum_ = F.when(v % 5 > 0, d.attribute("CHECKSUM", F.md5(v.cast("string").cast("binary")))).otherwise("")
    zipped = F.concat(F.lit('<M:fileGrp USE="zip archive"><M:file'), sum_, F.lit('><M:FLocat x:href="'), v, F.lit('.zip"/></M:file></M:fileGrp>'))
    xml = F.concat(F.lit('<M:mets xmlns:M="urn:m" xmlns:x="urn:x">'), marc, premis, F.lit("<M:fileSec>"), zipped, F.lit('<M:fileGrp USE="image">'), "image", F.lit('</M:fileGrp><M:fileGrp USE="ocr">'), "ocr", F.lit('</M:fileGrp></M:fileSec><M:structMap><M:div TYPE="volume">'), "pages", F.lit("</M:div></M:structMap>"), F.when(v % 97 == 0, "").otherwise("</M:mets>"))
    return joined.select("volume", xml.alias("xml"))


@query("repository_facts", """
  with v as (select distinct volume, volume % 97 > 0 as whole from volume_files), f as (select * from volume_files where volume % 97 > 0),
  e as (select p.* from premis_events p join v on v.volume = p.volume where v.whole and p.volume % 4 <> 1),
  w as (select v.volume, count(e.event_id) > 0 as has from v left join e on e.volume = v.volume where whole group by v.volume)
  select volume, 'METS_VALID' as kind, cast(null as varchar) as name, case when whole then 1 else 0 end as n, cast(null as varchar) as date from v
  union all select volume, 'FILETYPE', ext, count(*), null from f group by volume, ext
  union all select volume, 'FILETYPE', 'zip', 1, null from w
  union all select volume, case when volume % 5 > 0 then 'ZIP_CHECKSUM' else 'MISSING_METS_CHECKSUM' end, case when volume % 5 > 0 then md5(cast(volume as varchar)) end, null, null from w
  union all select volume, 'PREMIS_VERSION', case when not has then 'none' when volume % 4 = 0 then 'unknown' else 'premis2' end, null, null from w
  union all select volume, 'PREMIS_EVENT_TYPE', case when origin < 2 then 'UUID' else 'old' end, count(*), null from e group by 1, 2, 3
  union all select volume, 'PREMIS_AGENT_TYPE', 'code', count(*), null from e group by volume
  union all select volume, 'PREMIS_AGENT_TYPE', 'tool', count(*), null from e where origin = 0 group by volume
  union all select volume, case eventtype when 'capture' then 'CAPTURE' else 'MD5SUM' end, concat('agent', cast(origin as varchar)), null, cast(event_id as varchar) from e where eventtype in ('capture', 'message digest calculation')
  union all select volume, 'INGEST', null, null, cast(event_id as varchar) from e where eventtype = 'ingestion'
  union all select volume, 'MARC', null, case when volume % 3 = 0 then 1 else 0 end, null from w
  union all select volume, 'METS_MDSEC', case when volume % 3 = 0 then 'mdWrap; LABEL=bib; MDTYPE=MARC' else 'mdRef; MDTYPE=OTHER; OTHERMDTYPE=Item' end, null, null from w where volume % 3 < 2
  union all select volume, 'METS_MDSEC', 'mdWrap; MDTYPE=PREMIS', null, null from w where has
  union all select volume, 'PAGETAGS', null, count(distinct case when page % 4 = 0 then page end), null from f group by volume
  union all select volume, 'PAGES', null, count(distinct page), null from f group by volume
  union all select volume, 'IMAGE_SIZE', null, cast(coalesce(sum(case when ext in ('jp2', 'tif') then size end), 0) as bigint), null from f group by volume""", "volume_files", "premis_events")  # fmt: skip
def repository_facts(t: Tables) -> DataFrame:
    """Every fact that a repository audit takes from a METS."""
    return d.repository_facts(audited_mets(t))


@query("structmap_order", """
  with f as (select volume, page, concat(case when ext in ('jp2', 'tif') then 'IMA' when ext = 'txt' then 'OCR' else 'COO' end, lpad(cast(row_number() over (partition by volume, case when ext in ('jp2', 'tif') then 1 when ext = 'txt' then 2 else 3 end order by file) as string), 8, '0')) as file_id from volume_files),
  p as (select volume, page, row_number() over (partition by volume order by page) as position from (select distinct volume, page from volume_files))
  select volume, position, file_id from f join p using (volume, page)""", "volume_files")  # fmt: skip
def structmap_order(t: Tables) -> DataFrame:
    return d.mets_pages(volume_mets(t))


@query("mets_diff", "select volume, file as href, case when volume % 11 = 0 and ext = 'txt' then 'missing' when volume % 7 = 0 and ext = 'jp2' then 'changed' else 'same' end as status from volume_files", "volume_files")
def mets_diff(t: Tables) -> DataFrame:
    use = F.when(F.col("ext").isin("jp2", "tif"), "image").when(F.col("ext") == "txt", "ocr").otherwise("coordOCR")
    files = t.volume_files.withColumn("use", use)
    newer = files.filter("not (volume % 11 = 0 and ext = 'txt')").withColumn("size", F.when((F.col("volume") % 7 == 0) & (F.col("ext") == "jp2"), F.col("size") + 1).otherwise(F.col("size")))
    old, new = (d.mets_files(d.mets(d.with_ids(f))) for f in (files, newer))
    return d.differences(old, new)


@query("ocr_split", r"""
  with w as (select conv_id as volume, turn, coalesce(regexp_extract_all(text, '[A-Za-z]+'), []) as words, row_number() over (partition by conv_id order by turn) as page from conversations)
  select volume, page, coalesce(array_to_string([concat(array_to_string(words[a:a + 4], ' '), case when a + 5 <= len(words) then concat(chr(10), array_to_string(words[a + 5:a + 9], ' ')) else '' end) for a in range(1, len(words) + 1, 10)], concat(chr(10), chr(10))), '') as text
  from w""")  # fmt: skip
def ocr_split(t: Tables) -> DataFrame:
    """All words of each text in lines of five and paragraphs of two lines."""
    words = F.coalesce(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0), F.array().cast("array<string>"))
    rows = t.conversations.select("conv_id", "turn", words.alias("words"))
    line = lambda a: F.concat(F.lit("<LINE>"), F.array_join(F.transform(F.slice("words", a, 5), lambda w: F.concat(F.lit("<WORD>"), w, F.lit("</WORD>"))), ""), F.lit("</LINE>"))
    paragraph = lambda a: F.concat(F.lit("<PARAGRAPH>"), line(a), F.when(a + 5 <= F.size("words"), line(a + 5)).otherwise(""), F.lit("</PARAGRAPH>"))
    # greatest: a sequence can't end before it begins
    starts = F.when(F.size("words") > 0, F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(10))).otherwise(F.array().cast("array<int>"))
    page = F.concat(F.lit('<OBJECT usemap="x"><HIDDENTEXT>'), F.array_join(F.transform(starts, paragraph), ""), F.lit("</HIDDENTEXT></OBJECT>"))
    pages = rows.groupBy(F.col("conv_id").alias("volume")).agg(F.array_sort(F.collect_list(F.struct("turn", page.alias("x")))).alias("p"))
    return d.page_texts(pages.select("volume", F.concat(F.lit("<DjVuXML><BODY>"), F.array_join("p.x", ""), F.lit("</BODY></DjVuXML>")).alias("xml")))
