"""Results depend on each of these exactly, so they are stated in full."""

# --- Fixed values: address patterns -----------------------------------------------------

# RFC 2822 style address; the domain is one label, one dot, one label.
RFC_EMAIL = (
    r"([^\x00-\x20\x22\x28\x29\x2c\x2e\x3a-\x3c\x3e\x40\x5b-\x5d\x7f-\xff\x7c]+|\x22([^\x0d\x22\x5c\x80-\xff]|\x5c[\x00-\x7f])*\x22)"
    r"(\x2e([^\x00-\x20\x22\x28\x29\x2c\x2e\x3a-\x3c\x3e\x40\x5b-\x5d\x7f-\xff\x7c]+|\x22([^\x0d\x22\x5c\x80-\xff]|\x5c[\x00-\x7f])*\x22))*"
    r"\x40([^\x00-\x20\x22\x28\x29\x2c\x2e\x3a-\x3c\x3e\x40\x5b-\x5d\x7f-\xff\x7c]+|\x5b([^\x0d\x5b-\x5d\x80-\xff]|\x5c[\x00-\x7f])*\x5d)"
    r"(\x2e([^\x00-\x20\x22\x28\x29\x2c\x2e\x3a-\x3c\x3e\x40\x5b-\x5d\x7f-\xff\x7c]+|\x5b([^\x0d\x5b-\x5d\x80-\xff]|\x5c[\x00-\x7f])*\x5d))"
)
# The same with the pipe character allowed inside atoms and labels.
RFC_EMAIL_RELAXED = RFC_EMAIL.replace(r"\x7c", "")
# Plain address; keeps the whole domain.
SIMPLE_EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+(?:\.[a-zA-Z]{2,})+"
# Second check of the text lane, applied to the whole address.
STRICT_EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# --- Fixed values: extension routing ----------------------------------------------------

TEXT_BUCKET = "Dir_texto"
BUCKET_OF_EXTENSION = {
    "pdf": "Dir_PDF",
    "jpg": "Dir_Imagenes",
    "jpeg": "Dir_Imagenes",
    "png": "Dir_Imagenes",
    "bmp": "Dir_Imagenes",
    "tiff": "Dir_Imagenes",
    "svg": "Dir_Imagenes",
    "heif": "Dir_Imagenes",
    "heic": "Dir_Imagenes",
    "docx": "Dir_documentos",
    "doc": "Dir_documentos",
    "odt": "Dir_documentos",
    "rtf": "Dir_documentos",
    "epub": "Dir_documentos",
    "pptx": "Dir_documentos",
    "ppt": "Dir_documentos",
    "xlsx": "Dir_basesdatos",
    "pst": "Dir_basesdatos",
    "ods": "Dir_basesdatos",
    "xls": "Dir_basesdatos",
    "csv": "Dir_basesdatos",
    "json": "Dir_basesdatos",
    "sql": "Dir_basesdatos",
    "mdb": "Dir_basesdatos",
    "accdb": "Dir_basesdatos",
    "db": "Dir_basesdatos",
    "sqlite": "Dir_basesdatos",
    "xml": "Dir_basesdatos",
    "bson": "Dir_basesdatos",
    "ndjson": "Dir_basesdatos",
    "dump": "Dir_basesdatos",
    "pgsql": "Dir_basesdatos",
    "pgpass": "Dir_basesdatos",
    "frm": "Dir_basesdatos",
    "ibd": "Dir_basesdatos",
    "myd": "Dir_basesdatos",
    "myi": "Dir_basesdatos",
    "xql": "Dir_basesdatos",
    "dmp": "Dir_basesdatos",
    "ora": "Dir_basesdatos",
    "psql": "Dir_basesdatos",
    "nosql": "Dir_basesdatos",
    "yml": "Dir_texto",
    "md": "Dir_texto",
    "txt": "Dir_texto",
    "dat": "Dir_texto",
}

# --- Fixed values: thresholds and windows -----------------------------------------------

MIN_FILE_BYTES = 512
HEAD_LINES = 10
HEAD_PAGES = 30
DIGITAL_CHARS = 50
LINE_CONTEXT = 150
TEXT_CONTEXT = 500
XML_CONTEXT = 200

# --- Fixed values: words ----------------------------------------------------------------

CONTACT_HEADERS = ["name", "email"]
TITLE_WORD = "hiring"
TITLE_COMPANIONS = ["cv", "resume", "passport"]
DOCX_ORIGIN = "DOCX Archive"
PPTX_ORIGIN = "PPTX Archive"

# Later lanes overwrite earlier ones in the index.
LANE_ORDER = ["txt", "pdf", "docx", "pptx", "csv", "xls", "xml"]
# Lanes whose provenance starts with an origin of their own.
KEYED_LANES = ["txt", "pdf", "docx", "pptx"]

# --- Fixed values: record layouts -------------------------------------------------------

FINDING_FIELDS = ["id", "email", "email_context", "domain", "from", "id_source"]
IDENTITY_FIELDS = [
    "Country", "Authority", "Expiration Date", "Name", "Gender",
    "Date of Birth", "Address", "ID Number",
]
# Those that tell who somebody is.
IDENTIFYING_FIELDS = ["Name", "Date of Birth", "Address", "ID Number"]
IDENTITY_DATES = ["Expiration Date", "Date of Birth"]
SOURCE_FIELDS = [
    "post_title", "group_name", "discovered", "description", "website",
    "indexed", "post_url", "country", "id",
]

# What Python's str.strip() removes.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    chr(code) for code in [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
