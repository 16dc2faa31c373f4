"""A rule language over technical-metadata XML.

A library names paths in contexts; rules are predicates over these names. The paths of
a library compile to one nested schema, with attributes and repeated elements, by
which from_xml parses each document once on the JVM; contexts and values are array
expressions over that parse, and all rules of a set one select over them. Malformed
XML is a fact as well, not a failure of the job.

A path is local element names joined by /, the last of which may be @attribute; a
step may be narrowed as name[child=text] or name[@attribute=text]. Several paths may
stand for one name, whose nodes are those of all. A context may open in a document
that the outer one holds as text (`inner`): an XMP packet, for example.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "struct<code:string,field:string,expected:string,actual:string>"
Step = tuple[str, str, str]  # name, and the child or @attribute and the text that narrow it, if any
Paths = str | tuple[str, ...]


def steps(path: str) -> list[Step]:
    return re.findall(r"([^/\[]+)(?:\[([^=\]]+)=([^\]]*)\])?", path)


def several(paths: Paths) -> tuple[str, ...]:
    return (paths,) if isinstance(paths, str) else paths


class Node:
    """An element of the schema: what rules ask of it."""

    def __init__(self) -> None:
        self.children: dict[str, Node] = {}
        self.attributes: dict[str, None] = {}
        self.valued = False  # whether its own text is asked for

    def add(self, path: list[Step]) -> Node:
        if not path:
            return self
        (name, key, _), *rest = path
        if name.startswith("@"):
            self.attributes[name[1:]] = None
            return self
        child = self.children.setdefault(name, Node())
        if key:
            child.asked([(key, "", "")])
        return child.add(rest)

    def asked(self, path: list[Step]) -> None:
        """Add a path whose text is asked for."""
        node = self.add(path)
        node.valued = node.valued or not path[-1][0].startswith("@")

    def attributed(self) -> bool:
        """Whether an attribute is asked for, here or below."""
        return bool(self.attributes) or any(c.attributed() for c in self.children.values())

    def ddl(self) -> str:
        if not self.children and not self.attributes:
            return "string"
        fields = [f"`{n}`:array<{c.ddl()}>" for n, c in self.children.items()] + [f"`_{a}`:string" for a in self.attributes]
        # the parser's time goes by the fields of the elements, so that a text nobody asks for is none
        return f"struct<{','.join(fields + ['`_VALUE`:string'] * (self.valued or not self.children))}>"

    def text(self, x: Column) -> Column:
        if not self.children and not self.attributes:
            return x
        # between the children of an element there is only white space
        return F.when(F.trim(x["_VALUE"]) != "", x["_VALUE"]) if self.children else F.coalesce(x["_VALUE"], F.lit(""))

    def narrowed(self, key: str, text: str) -> Callable[[Column], Column]:
        if key.startswith("@"):
            return lambda x: F.coalesce(x[f"_{key[1:]}"] == text, F.lit(False))
        child = self.children[key]
        return lambda x: F.coalesce(F.exists(x[key], lambda v: child.text(v) == text), F.lit(False))

    def under(self, name: str) -> Callable[[Column], Column]:
        """The nodes like this one, by their name, of their parent."""
        none = F.array().cast(f"array<{self.ddl()}>")
        return lambda x: F.coalesce(x[name], none)

    def found(self, node: Column, path: list[Step]) -> tuple[Column, Node]:
        """The nodes that a path finds below a node like this one, as an array."""
        at, nodes = self, None
        for name, key, text in path:
            at = at.children[name]
            nodes = at.under(name)(node) if nodes is None else F.flatten(F.transform(nodes, at.under(name)))
            if key:
                nodes = F.filter(nodes, at.narrowed(key, text))
        return F.array(node) if nodes is None else nodes, at

    def values(self, node: Column, path: list[Step]) -> Column:
        """The texts of the nodes that a path finds, in their order."""
        *above, (last, _, _) = path
        if last.startswith("@"):
            nodes, _ = self.found(node, above)
            return F.filter(F.transform(nodes, lambda x: x[f"_{last[1:]}"]), lambda v: v.isNotNull())
        nodes, at = self.found(node, path)
        if not at.children and not at.attributes:
            return nodes
        return F.filter(F.transform(nodes, at.text), lambda v: v.isNotNull())


@dataclass
class Library:
    contexts: dict[str, tuple[str | None, Paths]] = field(default_factory=dict)  # name: (parent, paths from it)
    queries: dict[tuple[str, str], Paths] = field(default_factory=dict)  # (context, name): paths from the context
    inner: dict[str, Callable[[Reader], Column]] = field(default_factory=dict)  # context without parent: the texts that may hold its document
    listed: str | None = None  # an element without children, by which no step is narrowed, that may hold one number of a long list

    def __post_init__(self) -> None:
        self.documents = {name: Node() for name in ("", *self.inner)}
        self.nodes: dict[str, list[Node]] = {}  # of each context, one for each of its paths
        for name, (parent, paths) in self.contexts.items():
            above = self.nodes[parent] if parent else [self.documents[name if name in self.inner else ""]]
            self.nodes[name] = [n.add(steps(p)) for n in above for p in several(paths)]
        for (context, _), paths in self.queries.items():
            for node in self.nodes[context]:
                for p in several(paths):
                    node.asked(steps(p))

    def only(self, *names: tuple[str, str]) -> Library:
        """The library of some names only, given as (context, name), and of the contexts and inner documents that these need."""
        contexts = {c for c, _ in names}
        for name in reversed(self.contexts):  # parents come first
            if name in contexts and self.contexts[name][0]:
                contexts.add(self.contexts[name][0])
        return Library({k: v for k, v in self.contexts.items() if k in contexts}, {k: v for k, v in self.queries.items() if k in names}, {k: v for k, v in self.inner.items() if k in contexts}, self.listed)

    def read(self, documents: DataFrame, xml: str) -> DataFrame:
        """documents with a column `n:name` for each name, how many nodes it has, and `v:name`, the text of the first, and `m:name`, the errors if it is not found once; `read:` is false for malformed XML, `p:name` how many inner documents there are."""
        names = documents.columns
        text = F.col(xml)
        if self.listed:
            documents, text = _joined(documents, text, self.listed), F.col("text ")
        found = _parsed(documents, text, self.documents[""], "")
        for context, (parent, paths) in self.contexts.items():
            if context in self.inner:
                found = found.withColumn(f"packets {context}", self.inner[context](Reader(self)))
                one = F.when(F.size(f"packets {context}") == 1, F.get(f"packets {context}", F.lit(0)))
                found = _parsed(found, one, self.documents[context], context)
            document = context if context in self.inner else ""
            above, node = (self.nodes[parent][0], F.col(f"node {parent}")) if parent else (self.documents[document], F.when(_well_formed(document), F.col(f"document {document}")))
            parts = [above.found(node, steps(p))[0] for p in several(paths)]
            found = found.withColumn(f"context {context}", parts[0] if len(parts) == 1 else F.concat(*parts))
            found = found.withColumn(f"node {context}", F.get(f"context {context}", F.lit(0)))
        # every name a column of its own, not a field of a struct, so that no optimizer rule repeats an expression where it is used
        facts = [_well_formed("").alias("read:")]
        for context in self.contexts:
            parent = self.contexts[context][0]
            n = F.size(f"context {context}")
            # a context opens below the one node of its parent, and not at all where that isn't one
            facts.append((F.when(F.size(f"context {parent}") != 1, 0).otherwise(n) if parent else n).alias(f"n:{context}"))
            if context in self.inner:
                facts.append(F.size(f"packets {context}").alias(f"p:{context}"))
        every = {f"{c}.{n}": Reader(self).values(c, n) for c, n in self.queries}
        valued = found.select("*", *facts, *(v.alias(f"values {k}") for k, v in every.items()))
        told = [f for k in every for f in (F.size(F.col(f"`values {k}`")).alias(f"n:{k}"), F.get(F.col(f"`values {k}`"), F.lit(0)).alias(f"v:{k}"))]
        valued = valued.select(*(F.col(f"`{n}`") for n in names), *(F.col(f"`{c}`") for c in valued.columns if c[:2] in ("n:", "p:") or c == "read:"), *told)
        return valued.select("*", *(_missing(c, n).alias(f"m:{c}.{n}") for c, n in self.queries))


class Reader:
    """What a library's inner documents are made from: values of names that were opened before."""

    def __init__(self, library: Library) -> None:
        self.library = library

    def values(self, context: str, name: str) -> Column:
        """All texts of a name."""
        parts = [self._texts(context, F.col(f"node {context}"), p) for p in several(self.library.queries[context, name])]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def each(self, context: str, name: str, key: str, wanted: Column) -> Column:
        """The texts of a name in each of a context's nodes where those of another name are the wanted ones, as an array of arrays."""
        texts = lambda x, n: self._texts(context, x, several(self.library.queries[context, n])[0])
        mine = F.filter(F.col(f"context {context}"), lambda x: texts(x, key) == wanted)
        return F.transform(mine, lambda x: texts(x, name))

    def _texts(self, context: str, node: Column, path: str) -> Column:
        found = self.library.nodes[context][0].values(node, steps(path))
        # a document of an inner context is read as it is
        if context in self.library.inner or steps(path)[-1][0] != self.library.listed:
            return found
        return F.when(F.col("joined "), F.flatten(F.transform(found, lambda v: F.split(v, JOINT)))).otherwise(found)


XML = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}


def _options(root: Node) -> dict[str, str]:
    """Attributes are made only where some are asked for, as the parser spends time on them at each element."""
    return XML if root.attributed() else XML | {"excludeAttribute": "true"}


def _schema(root: Node) -> str:
    ddl = root.ddl()
    return f"{ddl[:-1]},`_broken`:string>" if ddl != "string" else "struct<`_VALUE`:string,`_broken`:string>"


def _parsed(documents: DataFrame, xml: Column, root: Node, name: str) -> DataFrame:
    """documents with `document name`: one parse of a text, whose declaration is taken off and which is set below one root, so that a second one would be seen."""
    # a trim by characters takes as long as a parse, so only where there is something to trim; as a column of its own it is done once
    documents = documents.withColumn(f"bare {name}", F.when(xml.startswith("<") & xml.endswith(">"), xml).otherwise(F.trim(xml, F.lit(" \t\r\n\ufeff"))))
    bare = F.col(f"bare {name}")
    declared = bare.startswith("<?xml") | bare.startswith("<!DOCTYPE")
    body = F.when(declared, F.regexp_replace(bare, r"^(<\?xml[^>]*\?>)?\s*(<!DOCTYPE[^\[>]*>)?", "")).otherwise(bare)
    whole = F.when(bare.startswith("<") & bare.endswith(">"), F.concat(F.lit("<_>"), body, F.lit("</_>")))
    return documents.withColumn(f"document {name}", F.from_xml(whole, _schema(root), _options(root))).drop(f"bare {name}")


#: What stands for the tags between two numbers of a list.
JOINT = "\x7f"


def _joined(documents: DataFrame, xml: Column, element: str) -> DataFrame:
    """documents with `text `, where neighbouring numbers of an element are one node, as the parser copies the nodes before at each; with anything else between such tags a document stays as it is."""
    between = f"</{element}><{element}>"
    tried = documents.withColumn("tried ", F.when(xml.contains(between) & ~xml.contains(JOINT) & ~xml.contains("<![CDATA[") & ~xml.contains("&#"), F.replace(xml, F.lit(between), F.lit(JOINT))))
    others = F.regexp_replace("tried ", f"<{element}>[-0-9]++(?:{JOINT}[-0-9]++)++</{element}>", "")
    told = tried.withColumn("joined ", F.coalesce(~others.contains(JOINT), F.lit(False)))
    return told.withColumn("text ", F.when(F.col("joined "), F.col("tried ")).otherwise(xml)).drop("tried ")


def _well_formed(name: str) -> Column:
    parsed = F.col(f"document {name}")
    return parsed.isNotNull() & parsed["_broken"].isNull()


def _count(name: str) -> Column:
    return F.col(f"`n:{name}`")


def _error(code: str, name: str, expected: Column, actual: Column) -> Column:
    return F.array(F.struct(F.lit(code).alias("code"), F.lit(name).alias("field"), expected.cast("string").alias("expected"), actual.cast("string").alias("actual")))


def _none() -> Column:
    return F.array().cast(f"array<{ERROR}>")


def _missing(ctx: str, name: str) -> Column:
    """Errors of a name that is not found exactly once."""
    n, opened = _count(f"{ctx}.{name}"), _count(ctx)
    return (
        F.when(opened != 1, _error("BadField", ctx, F.lit("one context"), opened)).when(n == 0, _error("MissingField", name, F.lit("one"), n))
        .when(n > 1, _error("BadField", name, F.lit("exactly one"), n)).otherwise(_none())
    )


def _found(ctx: str, name: str) -> Column:
    return F.col(f"`m:{ctx}.{name}`")


def _value(ctx: str, name: str) -> Column:
    return F.col(f"`v:{ctx}.{name}`")


def _tested(ctx: str, name: str, code: str, expected: Column, test: Callable[[Column], Column]) -> Column:
    value = _value(ctx, name)
    missing = _found(ctx, name)
    return F.when(F.size(missing) > 0, missing).when(F.coalesce(test(value), F.lit(False)), _none()).otherwise(_error(code, name, expected, value))


def number(text: Column) -> Column:
    """The integer that a text begins with; null where it begins otherwise."""
    return F.regexp_extract(text, r"^(\d+)", 1).try_cast("bigint")


def v_exists(ctx: str, name: str) -> Column:
    return _found(ctx, name)


def v_eq(ctx: str, name: str, expected: str) -> Column:
    return _tested(ctx, name, "BadValue", F.lit(expected), lambda v: v == expected)


def v_in(ctx: str, name: str, expected: list[str]) -> Column:
    return _tested(ctx, name, "BadValue", F.lit(" or ".join(expected)), lambda v: v.isin(*expected))


def v_between(ctx: str, name: str, low: int, high: int) -> Column:
    return _tested(ctx, name, "BadValue", F.lit(f"{low} to {high}"), lambda v: number(v).between(low, high))


def _compare(sign: str, test: Callable[[Column, int], Column]) -> Callable[[str, str, int], Column]:
    return lambda ctx, name, than: _tested(ctx, name, "BadValue", F.lit(f"{sign} {than}"), lambda v: test(number(v), than))


v_gt = _compare(">", lambda a, b: a > b)
v_lt = _compare("<", lambda a, b: a < b)
v_ge = _compare(">=", lambda a, b: a >= b)
v_le = _compare("<=", lambda a, b: a <= b)


def v_same(ctx1: str, name1: str, ctx2: str, name2: str) -> Column:
    """Both found once and equal; a missing one is reported by itself."""
    missing = F.concat(_found(ctx1, name1), _found(ctx2, name2))
    a, b = _value(ctx1, name1), _value(ctx2, name2)
    return F.when(F.size(missing) > 0, missing).when(a == b, _none()).otherwise(_error("NotEqualValues", name1, b, a))


def v_holds(names: list[tuple[str, str]], code: str, field: str, expected: str, test: Callable[..., Column]) -> Column:
    """A predicate over several values, each found once; missing ones are reported by themselves."""
    missing, values = F.concat(*(_found(*n) for n in names)), [_value(*n) for n in names]
    return F.when(F.size(missing) > 0, missing).when(F.coalesce(test(*values), F.lit(False)), _none()).otherwise(_error(code, field, F.lit(expected), F.concat_ws(", ", *values)))


def v_if_packet(ctx: str, rule: Column) -> Column:
    """A rule for documents that hold an inner one; several are an error, none is nothing to check."""
    n = F.col(f"`p:{ctx}`")
    return F.when(n == 0, _none()).when(n > 1, _error("BadField", ctx, F.lit("zero or one"), n)).otherwise(rule)


def _per_inch(axis: str) -> Column:
    whole, parts = _value("mix", f"{axis}Res_numerator").try_cast("double"), _value("mix", f"{axis}Res_denominator").try_cast("double")
    return F.when(_count(f"mix.{axis}Res_denominator") > 0, F.try_divide(whole, parts)).otherwise(whole)


def _resolution(expected: str, test: Callable[[Column], Column]) -> Column:
    """The resolution of both axes as one number, numerator by denominator if there is one."""
    missing, x, y = F.concat(_found("mix", "xRes_numerator"), _found("mix", "yRes_numerator")), _per_inch("x"), _per_inch("y")
    unequal = _error("NotEqualValues", "xRes_numerator", y, x)
    return F.when(F.size(missing) > 0, missing).when(F.coalesce(x != y, F.lit(True)), unequal).when(F.coalesce(test(x), F.lit(False)), _none()).otherwise(_error("BadValue", "xRes_numerator", F.lit(expected), x))


def v_resolution(allowed: list[int]) -> Column:
    return _resolution(f"one of ({', '.join(map(str, allowed))})", lambda x: x.isin(*map(float, allowed)))


def v_resolution_ge(least: int) -> Column:
    return _resolution(f">= {least}", lambda x: x >= least)


def v_resolution_exists() -> Column:
    return _resolution("a number", lambda x: x.isNotNull())


def v_and(*rules: Column) -> Column:
    """All errors of all rules: nothing is cut short."""
    return F.concat(*rules)


def merged(defaults: dict[str, Column], overrides: dict[str, Column | None]) -> dict[str, Column]:
    """A rule set with some rules replaced, and those overridden by None left out."""
    return {k: v for k, v in (defaults | overrides).items() if v is not None}


def check(documents: DataFrame, xml: str, library: Library, rules: dict[str, Column]) -> DataFrame:
    """documents with results, an array of (rule, errors); malformed XML fails every rule with BadFile."""
    parsed = library.read(documents, xml)
    broken = _error("BadFile", "xml", F.lit("well-formed XML"), F.lit(None))
    results = F.array(*(F.struct(F.lit(k).alias("rule"), F.when(~F.col("read:"), broken).otherwise(v).alias("errors")) for k, v in rules.items()))
    return parsed.select(*(F.col(f"`{c}`") for c in documents.columns if c != "results"), results.alias("results"))


def _results(checked: DataFrame, keys: list[str]) -> DataFrame:
    # outer: for a plain explode the optimizer would add a filter on the array's size and repeat the parse in it
    return checked.select(*keys, F.explode_outer("results").alias("r")).select(*keys, "r.rule", "r.errors")


def verdicts(checked: DataFrame, keys: list[str]) -> DataFrame:
    return _results(checked, keys).select(*keys, "rule", (F.size("errors") == 0).alias("ok"))


def errors(checked: DataFrame, keys: list[str]) -> DataFrame:
    return _results(checked, keys).select(*keys, "rule", F.explode_outer("errors").alias("e")).filter("e is not null").select(*keys, "rule", "e.*")


#: Names in technical metadata of TIFF images.
TIFF = Library(
    contexts={"repInfo": (None, "repInfo"), "mix": ("repInfo", "mix")},
    queries={
        ("repInfo", "format"): "format", ("repInfo", "status"): "status", ("repInfo", "mimeType"): "mimeType",
        ("mix", "xRes"): "xRes", ("mix", "width"): "width", ("mix", "height"): "height", ("mix", "bitsPerSample"): "bits/@perSample", ("mix", "copyOfWidth"): "copyOfWidth",
    },
)


def tiff_rules() -> dict[str, Column]:
    return {
        "format": v_eq("repInfo", "format", "TIFF"), "status": v_eq("repInfo", "status", "Well-Formed and valid"), "resolution": v_ge("mix", "xRes", 600),
        "bits": v_in("mix", "bitsPerSample", ["1", "2"]), "dimensions": v_and(v_gt("mix", "width", 0), v_gt("mix", "height", 0)), "same_width": v_same("mix", "width", "mix", "copyOfWidth"), "height_range": v_between("mix", "height", 0, 1600),
    }


#: Where the format puts image metadata (MIX), by the names that rules use.
MIX = {
    "compression": "BasicDigitalObjectInformation/Compression/compressionScheme", "colorSpace": "BasicImageInformation/BasicImageCharacteristics/PhotometricInterpretation/colorSpace",
    "width": "BasicImageInformation/BasicImageCharacteristics/imageWidth", "length": "BasicImageInformation/BasicImageCharacteristics/imageHeight",
    "orientation": "ImageCaptureMetadata/orientation", "artist": "ImageCaptureMetadata/GeneralCaptureInformation/imageProducer", "dateTime": "ImageCaptureMetadata/GeneralCaptureInformation/dateTimeCreated",
    "xRes_numerator": "ImageAssessmentMetadata/SpatialMetrics/xSamplingFrequency/numerator", "xRes_denominator": "ImageAssessmentMetadata/SpatialMetrics/xSamplingFrequency/denominator",
    "yRes_numerator": "ImageAssessmentMetadata/SpatialMetrics/ySamplingFrequency/numerator", "yRes_denominator": "ImageAssessmentMetadata/SpatialMetrics/ySamplingFrequency/denominator",
    "resUnit": "ImageAssessmentMetadata/SpatialMetrics/samplingFrequencyUnit", "bitsPerSample": "ImageAssessmentMetadata/ImageColorEncoding/BitsPerSample/bitsPerSampleValue", "samplesPerPixel": "ImageAssessmentMetadata/ImageColorEncoding/samplesPerPixel",
}
#: Elements of an XMP description.
XMP = {
    "width": "ImageWidth", "length": "ImageLength", "bitsPerSample": ("BitsPerSample/Seq/li", "BitsPerSample"), "compression": "Compression", "colorSpace": "PhotometricInterpretation", "orientation": "Orientation", "samplesPerPixel": "SamplesPerPixel",
    "xRes": "XResolution", "yRes": "YResolution", "resUnit": "ResolutionUnit", "dateTime": "DateTime", "artist": "Artist", "make": "Make", "model": "Model", "documentName": "source",
}
REP_INFO = {"format": "format", "status": "status", "module": "sigMatch/module", "mimeType": "mimeType"}
DESCRIPTION = ("xmpmeta/RDF/Description", "RDF/Description")
#: The box id of XMP in JP2 images, as signed bytes.
XMP_BOX = (-66, 122, -49, -53, -105, -87, 66, -24, -100, 113, -103, -108, -111, -29, -81, -84)


def _named(**queries: dict[str, Paths]) -> dict[tuple[str, str], Paths]:
    return {(context, name): path for context, paths in queries.items() for name, path in paths.items()}


def _boxes(read: Reader) -> Column:
    """The data of the boxes with XMP's id, whose bytes are listed as signed numbers."""
    mine = read.each("uuidBox", "data", "uuid", F.array(*(F.lit(str(x)) for x in XMP_BOX)))
    digits = F.array(*(F.lit(f"{n:02X}") for n in range(256)))
    byte = lambda v: F.get(digits, v.try_cast("int").bitwiseAND(F.lit(255)))
    return F.transform(mine, lambda data: F.decode(F.unhex(F.array_join(F.transform(data, byte), "")), "UTF-8"))


#: A whole report on a TIFF image, with the XMP packet that it may hold as text.
TIFF_REPORT = Library(
    contexts={
        "repInfo": (None, "jhove/repInfo"), "tiffMeta": ("repInfo", "properties/property[name=TIFFMetadata]/values/property[name=IFDs]/values/property[name=IFD]/values"),
        "mix": ("tiffMeta", "property[name=NisoImageMetadata]/values/value/mix"), "xmp": (None, DESCRIPTION),
    },
    queries=_named(repInfo=REP_INFO, tiffMeta={"documentName": "property[name=DocumentName]/values/value", "xmp": "property[name=XMP]/values/value"}, mix=MIX, xmp=XMP),
    inner={"xmp": lambda read: read.values("tiffMeta", "xmp")},
)

#: A whole report on a JP2 image; its XMP packet is in a box, byte by byte.
JP2_REPORT = Library(
    contexts={
        "repInfo": (None, "jhove/repInfo"), "jp2Meta": ("repInfo", "properties/property[name=JPEG2000Metadata]/values"), "codestream": ("jp2Meta", "property[name=Codestreams]/values/property[name=Codestream]/values"),
        "codingStyleDefault": ("codestream", "property[name=CodingStyleDefault]/values"), "mix": ("codestream", "property[name=NisoImageMetadata]/values/value/mix"),
        "uuidBox": ("jp2Meta", "property[name=UUIDs]/values/property[name=UUIDBox]/values"), "xmp": (None, DESCRIPTION),
    },
    queries=_named(
        repInfo=REP_INFO,
        jp2Meta={"brand": "property[name=Brand]/values/value", "minorVersion": "property[name=MinorVersion]/values/value", "compatibility": "property[name=Compatibility]/values/value", "colorSpace": "property[name=ColorSpecs]/values/property[name=ColorSpec]/values/property[name=EnumCS]/values/value"},
        codingStyleDefault={"layers": "property[name=NumberOfLayers]/values/value", "decompositionLevels": "property[name=NumberDecompositionLevels]/values/value", "transformation": "property[name=Transformation]/values/value"},
        mix=MIX, xmp=XMP, uuidBox={"uuid": "property[name=UUID]/values/value", "data": "property[name=Data]/values/value"},
    ),
    inner={"xmp": _boxes}, listed="value",
)


def tiff_report_rules() -> dict[str, Column]:
    """A bitonal TIFF; if it has XMP, that must say the same as the image's own header."""
    same = [v_same("mix", k, "xmp", k) for k in ("bitsPerSample", "samplesPerPixel", "length", "width", "artist")] + [v_same("tiffMeta", "documentName", "xmp", "documentName")]
    fixed = [v_eq("xmp", k, v) for k, v in {"compression": "4", "colorSpace": "0", "orientation": "1", "resUnit": "2"}.items()]
    # the header has no time zone, XMP may have one
    dated = v_holds([("mix", "dateTime"), ("xmp", "dateTime")], "NotMatchedValue", "dateTime", "the same time", lambda own, xmp: xmp.startswith(own))
    dense = v_holds([("mix", "xRes_numerator"), ("xmp", "xRes")], "BadValue", "xRes", "NNN/1, as in the header", lambda _, xmp: xmp.rlike(r"^\d+/1\z") & (number(xmp) == _per_inch("x")))
    return {
        "format": v_eq("repInfo", "format", "TIFF"), "status": v_eq("repInfo", "status", "Well-Formed and valid"), "module": v_eq("repInfo", "module", "TIFF-hul"), "mime_type": v_eq("repInfo", "mimeType", "image/tiff"),
        "compression": v_eq("mix", "compression", "Group 4 Fax"), "colorspace": v_eq("mix", "colorSpace", "WhiteIsZero"), "orientation": v_eq("mix", "orientation", "normal*"), "resolution": v_resolution([600]),
        "resolution_unit": v_eq("mix", "resUnit", "in."), "bits_per_sample": v_eq("mix", "bitsPerSample", "1"), "samples_per_pixel": v_eq("mix", "samplesPerPixel", "1"), "dimensions": v_and(v_gt("mix", "length", 0), v_gt("mix", "width", 0)),
        "extract_info": v_and(v_exists("mix", "dateTime"), v_exists("mix", "artist"), v_exists("tiffMeta", "documentName")),
        "xmp": v_if_packet("xmp", v_and(*same, *fixed, dated, dense, v_same("xmp", "xRes", "xmp", "yRes"))), "camera": v_if_packet("xmp", v_and(v_exists("xmp", "make"), v_exists("xmp", "model"))),
    }


def jp2_report_rules() -> dict[str, Column]:
    """A lossy JP2 of grey or true colour, whose XMP, which it must have, agrees with its codestream."""
    grey = {"xmp.colorSpace": "1", "xmp.samplesPerPixel": "1", "mix.samplesPerPixel": "1", "jp2Meta.colorSpace": "Greyscale"}
    colour = {"xmp.colorSpace": "2", "xmp.samplesPerPixel": "3", "mix.samplesPerPixel": "3", "jp2Meta.colorSpace": "sRGB"}
    names = [tuple(k.split(".")) for k in grey]
    depth = lambda ctx, n: (_count(f"{ctx}.bitsPerSample") == n) & (_value(ctx, "bitsPerSample") == "8")
    all_of = lambda values, wanted, n: F.forall(F.array(*(v == w for v, w in zip(values, wanted.values()))), lambda x: F.coalesce(x, F.lit(False))) & depth("mix", n) & depth("xmp", n)
    sizes = [("mix", "width"), ("xmp", "width"), ("mix", "length"), ("xmp", "length")]
    return {
        "format": v_eq("repInfo", "format", "JPEG 2000"), "status": v_eq("repInfo", "status", "Well-Formed and valid"), "module": v_eq("repInfo", "module", "JPEG2000-hul"), "mime_type": v_eq("repInfo", "mimeType", "image/jp2"),
        "brand": v_eq("jp2Meta", "brand", "jp2 "), "minor_version": v_eq("jp2Meta", "minorVersion", "0"), "compatibility": v_eq("jp2Meta", "compatibility", "jp2 "),
        "compression": v_and(v_eq("mix", "compression", "JPEG2000 Lossy"), v_eq("xmp", "compression", "34712")), "orientation": v_eq("xmp", "orientation", "1"), "resolution_unit": v_eq("xmp", "resUnit", "2"),
        "resolution": v_and(v_ge("xmp", "xRes", 300), v_same("xmp", "xRes", "xmp", "yRes")), "layers": v_eq("codingStyleDefault", "layers", "1"), "decomposition_levels": v_between("codingStyleDefault", "decompositionLevels", 5, 32),
        "transformation": v_eq("codingStyleDefault", "transformation", "0"), "colorspace": v_holds(names, "NotMatchedValue", "color space", "grey or sRGB of 8 bits", lambda *v: all_of(v, grey, 1) | all_of(v, colour, 3)),
        "dimensions": v_holds(sizes, "NotMatchedValue", "dimensions", "consistent and not zero", lambda a, b, c, d: (number(a) > 0) & (number(a) == number(b)) & (number(c) > 0) & (number(c) == number(d))),
        "extract_info": v_and(v_exists("xmp", "dateTime"), v_exists("xmp", "artist"), v_exists("xmp", "documentName")), "camera": v_and(v_exists("xmp", "make"), v_exists("xmp", "model")),
    }
