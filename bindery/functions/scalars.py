"""Scalar functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The alphabet of check characters, whose order gives each its number.
NOID_ALPHABET = "0123456789bcdfghjkmnpqrstvwxz"
#: Dots per inch for one of each unit.
DPI_FACTORS = {"um": 25400.0, "0.01 mm": 2540.0, "0.1 mm": 254.0, "mm": 25.4, "cm": 2.54, "m": 0.0254, "km": 0.0000254, "in": 1.0, "inches": 1.0}
#: Page types of scan data and the page tags they stand for.
PAGE_TAGS = {
    "Blank Tissue": "BLANK",
    "Chapter": "CHAPTER_START",
    "Contents": "TABLE_OF_CONTENTS",
    "Copyright": "COPYRIGHT",
    "Cover": "COVER",
    "Foldout": "FOLDOUT",
    "Illustration": "IMAGE_ON_PAGE",
    "Illustrations": "IMAGE_ON_PAGE",
    "Index": "INDEX",
    "Tissue": "BLANK",
    "Title": "TITLE",
    "Title Page": "TITLE",
}
#: Agent codes of old records and the institutions that they name.
AGENTS = {
    "Ca-MvGOO": "google",
    "CaSfIA": "archive",
    "DeU": "udel",
    "GEU": "emory",
    "GEU-S": "emory",
    "GEU-T": "emory",
    "IU": "illinois",
    "Internet Archive": "archive",
    "MiU": "umich",
    "MnU": "umn",
    "TxCM": "tamu",
    "UM": "umich",
}
#: Error codes and their messages.
ERRORS = {
    "BadChecksum": "Checksum error",
    "BadField": "Error extracting field",
    "BadFile": "File validation failed",
    "BadFilegroup": "File group empty or contains too many items",
    "BadFilename": "Invalid filename",
    "BadUTF": "UTF-8 validation error",
    "BadValue": "Invalid value for field",
    "Disallowed": "Not allowed to be queued (on disallow list)",
    "OperationFailed": "Operation failed",
    "FatalError": "Fatal error",
    "GRINError": "GRIN could not convert book",
    "IncompleteStage": "Stage did not complete",
    "MissingField": "Missing field value",
    "MissingFile": "Missing file",
    "NotEqualValues": "Mismatched field values",
    "NotMatchedValue": "Mismatched/invalid value for field",
    "NoBibData": "Missing bibliographic data",
    "ToolVersionError": "Can't get tool version",
    "VolumePunted": "Volume punted",
    "RunStage": "Running stage",
    "UnexpectedError": "Unexpected error",
    "StageSucceeded": "Stage succeeded",
    "StageFailed": "Stage failed",
}
#: Fixed value: the namespace of name-based event ids.
UUID_NAMESPACE = "09A5DAD6-3484-11E0-9D45-077BD5215A96"


def looked_up(table: dict[str, str], key: Column) -> Column:
    """The table's entry, or null."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without one or where the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def version_path(base: Column, namespace: Column, pairtree_id: Column, version: Column) -> Column:
    """Where a version is backed up: the folder is the id without its last four characters, three at least."""
    prefix = F.substring(pairtree_id, F.lit(1), F.greatest(F.length(pairtree_id) - 4, F.lit(3)))
    return F.concat_ws("/", base, namespace, prefix, F.concat_ws(".", pairtree_id, version, F.lit("zip")))


def pairtree_path(base: Column, namespace: Column, pairtree_id: Column) -> Column:
    """base/namespace/pairtree_root/ab/cd/e/id: the id in steps of two characters."""
    steps = F.regexp_replace(pairtree_id, "(..)(?=.)", "$1/")
    return F.concat_ws("/", base, namespace, F.lit("pairtree_root"), steps, pairtree_id)


def md5_base64(md5_hex: Column) -> Column:
    return F.base64(F.unhex(md5_hex))


def md5_from_base64(text: Column) -> Column:
    return F.lower(F.hex(F.unbase64(text)))


def luhn_valid(prefix: str, barcode: Column) -> Column:
    """Five given digits, nine more, and a right check digit."""
    return barcode.rlike(rf"^{prefix}\d{{9}}$") & F.call_function("luhn_check", barcode)


def noid_check_char(name: Column) -> Column:
    """The check character of a name: positions times numbers of its characters, modulo the alphabet's size."""
    number = lambda i: F.greatest(F.instr(F.lit(NOID_ALPHABET), F.substring(name, i, F.lit(1))) - 1, F.lit(0)) * i
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(name)), number), F.lit(0), lambda a, x: a + x)
    return F.substring(F.lit(NOID_ALPHABET), F.pmod(total, F.lit(len(NOID_ALPHABET))) + 1, F.lit(1))


def ark_valid(ark: Column) -> Column:
    """Whether an id of the one scheme ends in its check character, or in + to ask for it."""
    name = F.regexp_replace(ark, "^ark:/", "")
    last = F.right(name, F.lit(1))
    return ark.startswith("ark:/13960/") & ((last == "+") | (last == noid_check_char(F.left(name, F.length(name) - 1))))


def event_uuid(namespace: Column, objid: Column, event_type: Column, date: Column) -> Column:
    """The name-based (version 3) UUID of an event: md5 with its version and variant bits set."""
    name = F.encode(F.concat_ws("-", namespace, objid, event_type, date), "UTF-8")
    h = F.md5(F.concat(F.unhex(F.lit(UUID_NAMESPACE.replace("-", ""))), name))
    variant = F.substring(F.lit("89ab"), F.pmod(F.conv(F.substring(h, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def iso_date(text: Column) -> Column:
    """ISO 8601 from the accepted spellings: seconds :00 and zone Z where absent; else null."""
    m = r"^(\d{4})[:/-](\d\d)[:/-](\d\d)[T ](\d\d):(\d\d)(:\d\d)?(Z|[+-]\d{2}:\d{2})?$"
    g = lambda i: F.regexp_extract(text, m, i)
    return F.when(text.rlike(m), F.concat(g(1), F.lit("-"), g(2), F.lit("-"), g(3), F.lit("T"), g(4), F.lit(":"), g(5), F.coalesce(F.nullif(g(6), F.lit("")), F.lit(":00")), F.coalesce(F.nullif(g(7), F.lit("")), F.lit("Z"))))


def tiff_date(text: Column) -> Column:
    """YYYY:MM:DD HH:MM:SS from four accepted shapes, tried in order; else null."""
    shapes = (
        (r"^(\d{4}).(\d{2}).(\d{2}).(\d{2}).(\d{2}).(\d{2})", "$1:$2:$3 $4:$5:$6"), (r"^(\d{4}).?(\d{2}).?(\d{2})", "$1:$2:$3 00:00:00"),
        (r"^(\d{2})/(\d{2})/(9\d)$", "19$3:$1:$2 00:00:00"), (r"^(\d{2})[/:-](\d{2})[/:-](\d{4})$", "$3:$1:$2 00:00:00"),
    )
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for shape, form in shapes:
        out = out.when(text.rlike(shape), F.regexp_replace(F.regexp_extract(text, shape, 0), shape, form))
    return out


def utc_text(local: Column, zone: str) -> Column:
    return F.date_format(F.to_utc_timestamp(local, zone), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def dpi(value: Column, unit: Column) -> Column:
    """Whole dots per inch, halves to even; null for unknown units and no value."""
    factor = F.try_element_at(F.create_map(*(F.lit(x) for pair in DPI_FACTORS.items() for x in pair)), unit)
    return F.when(value != 0, F.bround(value * factor).cast("long"))


def resolution(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, F.coalesce(denominator, F.lit(1)))


def decomposition_levels(width: Column, height: Column) -> Column:
    return F.greatest(F.lit(5), F.ceil(F.log2(F.greatest(width, height) / 100.0)) - 1).cast("int")


def page_label(hand_side: Column, page_type: Column) -> Column:
    return F.nullif(F.concat_ws(", ", F.nullif(hand_side, F.lit("")), looked_up(PAGE_TAGS, page_type)), F.lit(""))


def allowed_tags(label: Column, allowed: list[str]) -> Column:
    """The known tags of a comma list; null where none is."""
    kept = F.filter(F.split(label, r",\s*"), lambda x: x.isin(*allowed))
    return F.nullif(F.array_join(kept, ", "), F.lit(""))


def migrate_agent(kind: Column, value: Column, namespace: Column) -> Column:
    """The institution of an old agent; `BadValue` where it is unknown, unchanged where it is new already."""
    old = F.coalesce(looked_up(AGENTS, value), F.lit("BadValue"))
    return F.when(kind.isin("MARC21 Code", "AgentID"), old).when(kind == "Repository AgentID", F.when((value == "UNKNOWN") & (namespace == "mdp"), "umich").otherwise("BadValue")).when(kind.isin("Institution ID", "tool"), value).otherwise("BadValue")


def error_text(code: Column) -> Column:
    return F.coalesce(looked_up(ERRORS, code), code)


def labels(text: Column) -> Column:
    """a:b;c:d as a map."""
    return F.str_to_map(text, F.lit(";"), F.lit(":"))


def source_agents(text: Column) -> Column:
    """Agents of a ;-list with their display flag; the last is displayed where none is marked."""
    marked = F.when(text.contains("*"), text).otherwise(F.concat(text, F.lit("*")))
    return F.transform(F.split(marked, ";"), lambda a: F.struct(F.regexp_replace(a, r"\*$", "").alias("agent"), F.when(a.endswith("*"), "yes").otherwise("no").alias("display")))


def capture_agent(text: Column) -> Column:
    """The last agent marked with *, else the first."""
    agents = F.split(text, ";")
    return F.regexp_replace(F.coalesce(F.try_element_at(F.filter(agents, lambda a: a.endswith("*")), F.lit(-1)), agents[0]), r"\*$", "")


def document_name_ok(name: Column, objid: Column, file: Column) -> Column:
    """Contains id/file, whatever the case."""
    return F.lower(name).contains(F.lower(F.concat_ws("/", objid, file)))


def md5_lookup(checksums: Column, name: Column) -> Column:
    """A checksum by file name, or by the escaped name; only one of 32 characters counts."""
    found = F.coalesce(F.try_element_at(checksums, name), F.try_element_at(checksums, F.replace(F.url_encode(name), F.lit("+"), F.lit("%20"))))
    return F.when(F.length(found) == 32, found)


def clean_lines(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "\r(?=\n|$)", ""), "\f", "")
