"""Fixed values.

These lists have to equal the ones users rely on today, so they are stated
plainly and in their usual order.  Nothing here is computed.
"""

# A link whose path ends in one of these is a media file.
MEDIA_EXTENSIONS = (
    ".jpg", ".jpeg", ".png", ".gif", ".svg", ".mp4", ".mov", ".webm",
    ".ogv", ".flv", ".mfv", ".m4v", ".mpg", ".mpeg", ".mkv", ".wmv",
    ".wav", ".mp3", ".aac", ".flac", ".ogg", ".weba", ".opus", ".ico",
    ".bmp", ".tiff", ".tif", ".webp", ".mpd", ".pdf", ".psd", ".raw",
    ".cr2", ".nef", ".orf", ".sr2", ".arw",
)

# A link with one of these as a whole path segment is skipped.
PROHIBITED_SEGMENTS = (
    "image", "img", "icon", "video", "audio", "file",
    "login", "log-in", "register", "session", "account", "auth",
    "logout", "log-out", "signin", "sign-in", "preferences", "settings",
    "profile", "id", "token", "form", "submit", "user",
    "password", "security", "secure", "payment", "checkout",
)

# Response codes that mean "slow down".
THROTTLE_CODES = (
    400, 401, 403, 404, 408, 420, 421, 425, 429, 500, 502, 503, 504, 509,
)

# Image suffixes taken by deduplication and by inference.
DEDUP_EXTENSIONS = (".png", ".jpg", ".jpeg")
INFERENCE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp")

# Scheme classes of the public URL rules (relative references,
# authority part, path parameters).
RELATIVE_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https",
    "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn",
    "svn+ssh", "ws", "wss",
)
AUTHORITY_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
    "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu",
    "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
    "itms-services",
)
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
    "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
)

# Characters that compatibility-normalise to one of / ? # @ :
# and therefore may not stand in a host.
CONFUSABLE_HOST_CHARS = (
    "⁇⁈⁉℀℁℅℆⩴︓︖﹕"
    "﹖﹟﹫＃／：？＠"
)

# Defaults of the crawl, the download and the hash comparison.
MAX_DEPTH = 5
BATCH_SIZE = 500
MAX_ATTEMPTS = 3
RATE_LIMIT = 600
RATE_SECONDS = 60
VISIBLE_TASKS = 15
HASH_SIZE = 8
SIMILARITY_THRESHOLD = 5
INFERENCE_BATCH = 3
BASE_FOLDER = "Downloaded_Images"
