"""Fixed values.

Word lists, marks, thresholds and patterns that results depend on.  They are
data, stated once here; every function takes them as a default argument.
"""

# --- fixed values: marks inside a raw line -------------------------------
ENVELOPE_MARK = "@|@"
HASH_SEPARATOR = "#_#"
WILDCARD_PREFIX = "ext."
WILDCARD_TYPE = "2"
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
STAMP_FORMAT = "yyyyMMddHHmmss"
MINUTE_FORMAT = "yyyyMMddHHmm"
JSON_FAILURE_MARK = "_jsonparsefailure"
NO_HIT_TEXT = "unkown"

# --- fixed values: format words of the first token -----------------------
POWZA_WORD = "POWZA"
MEDIA_WORD = "MEDIA"

# --- fixed values: file suffixes that keep their own class ---------------
SUFFIXES_BASE = (
    "jpg gif png bmp ico swf css js htm html doc docx pdf ppt txt zip rar "
    "gz tgz exe xls cvs xlsx pptx mp3 mp4 rm mpeg wav m3u wma avi mov av "
    "flv f4v hlv f4fmp4 f4fmp3 ts dv fhv xml apk vxes ipa deb"
).split()
SUFFIXES_EDGE = ["m3u8", *SUFFIXES_BASE, "jpeg"]

# --- fixed values: user-agent words, first match wins --------------------
UA_KEYWORDS = "android iphone ipad letv miui firefox chrome linux windows".split()
UA_TV = ["inphic", "miui", "letv", "diyomate"]
UA_MOBILE = ["android", "iphone", "ipad"]
UA_PC = ["windows nt", "linux", "msie", "firefox", "chrome"]

# --- fixed values: hit types ---------------------------------------------
HIT, PARENT_HIT, SOURCE, PARENT_MISS, MISS_OTHER = 0, 1, 2, 3, 4

# --- fixed values: thresholds --------------------------------------------
LATE_SECONDS = 600
SPEED_MIN_KBPS = 5
SPEED_MAX_KBPS = 10240
FAST_FLAG_KBPS = 80
SLOW_FLAG_KBPS = 100
SLOW_MIN_BYTES = 256 * 1024
LARGE_MIN_BYTES = 3 * 1024 * 1024
ES_LIMIT_MS = 20000.0
ES_LIMIT_LARGE_MS = 20000000.0
STORED_MINUTE_REACH = 12 * 30 * 24 * 60 * 60
STOP_SLACK_SECONDS = 1200
PAYLOAD_BATCH = 300

# --- fixed values: default customer and watched-domain lists -------------
HASH_USERID = "1159"
SLOW_DOMAINS = ["wasu.cloudcdn.net", "kwmov.a.yximgs.com"]
DIR_SCHEMA_KEYS = ["schema_desc", "domain_schema"]

# --- fixed values: format-string field names -> output columns -----------
FORMAT_FIELDS = {
    "%>a": "ip",
    "%es": "es",
    "%ss": "ss",
    "%lt": "lt",
    "%rm %ru %rv": "rm_ru_rv",
    "%Fs": "fs",
    "%cs": "cs",
    "%rf": "rf",
    "%ua": "ua",
    "%st": "st",
    "%tl": "tl_es",
    "%dd": "dd",
    "%rk": "rk",
    "%up": "up",
    "%Fa": "fa",
    "%Fv": "fv",
}
FORMAT_SHIFT_FIELD = "%tl"
FORMAT_SHIFT = 8
