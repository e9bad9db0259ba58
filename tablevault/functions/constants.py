"""Fixed values that results depend on.

They are stated here once, as plain text, so every operator and every oracle
query shares them.
"""

# --- fixed values: id and zone patterns scraped from cloud listings -------
# A volume id is "vol-" and the next 8 characters (longer ids are cut to 8).
VOLUME_ID_PATTERN = r"vol-.{8}"
# An instance id follows a non-word character; group 1 is "i-" and 8 characters.
INSTANCE_ID_PATTERN = r"\W(i-.{8})"
INSTANCE_ID_GROUP = 1
# Availability zones; greedy, so a trailing quote can be taken along.
ZONE_PATTERN = r"us-.{6,7}|eu-.{6,10}|ap-.{11,12}|sa-.{6,7}"

# --- fixed values: copy methods ----------------------------------------
METHODS = ("dd", "rsync")
DEFAULT_METHOD = "dd"

# --- fixed values: block copy ---------------------------------------------
# dd without bs= copies 512-byte records and pads the last one with NUL.
BLOCK_SIZE = 512
# Transfer rates are in MB of 10^6 bytes.
BYTES_PER_MB = 1_000_000

# --- fixed values: sizing -------------------------------------------------
# kib * 2, then two truncating divisions by 1024, then + 2.
SIZE_FACTOR = 2
KIB_PER_GIB = 1024 * 1024
SIZE_HEADROOM_GIB = 2

# --- fixed values: waiting ------------------------------------------------
POLL_INTERVAL_S = 10
TERMINATED = "terminated"

# --- fixed values: what a volume probe can report -------------------------
RAW_CONTENT = "data"
SUPPORTED_FILESYSTEMS = ("ext4", "ffs")

# --- fixed values: routing tables, in rule order --------------------------
# (method, has_volume) -> plan letter
PLAN_RULES = (
    ("dd", True, "a"),
    ("dd", False, "b"),
    ("rsync", True, "c"),
    ("rsync", False, "d"),
)
# instance state -> action
STATE_ACTIONS = (
    ("running", "proceed"),
    ("pending", "wait"),
    ("stopped", "start"),
)

# --- fixed values: cleanup order (instance, then group, then key; volume last)
CLEANUP_ORDER = ("instance", "group", "key", "volume")

# Fixed patterns of a copy tool's report: bytes, seconds, and records in or out.
TRANSFER_BYTES = r"(\d+) bytes"
TRANSFER_SECONDS = r"copied, ([0-9]+(?:\.[0-9]+)?) s"
RECORDS = r"(\d+)\+(\d+) records (in|out)"
