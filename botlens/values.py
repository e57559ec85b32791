"""Fixed values. Detection results depend on these exact words, names and formats."""

# --- fixed values: User-Agent words (lower-case substrings) -----------------
SUSPICIOUS_AGENTS = (
    "bot", "crawler", "spider", "scraper", "curl", "wget", "python-requests",
    "scrapy", "java", "go-http-client", "apache-httpclient", "libwww", "mechanize",
)
SUSPICIOUS_AGENTS_EXTENDED = SUSPICIOUS_AGENTS + ("selenium", "phantom")
WELCOME_AGENTS = ("googlebot", "bingbot", "slackbot")
TOOL_AGENTS = (
    "bot", "crawler", "spider", "scan", "nmap", "nikto", "sqlmap", "curl", "wget", "python",
)
BROWSER_AGENTS = ("mozilla", "chrome", "safari", "firefox", "edge", "opera")

# --- fixed values: request paths that probes ask for ------------------------
ADMIN_PATH_PATTERN = "/admin|/wp-admin"
PROBE_PATHS = (
    "/admin", "/wp-admin", "/phpmyadmin", "/.env", "/config.php", "/backup.sql",
    "/admin/login", "/.git/config", "/api/internal", "/xmlrpc.php", "/wp-login.php",
    "/administrator",
)

# --- fixed values: access-log line format -----------------------------------
# Group 9 marks a present referer/agent tail, so that an empty agent ("") and
# a missing one can be told apart.
ACCESS_LOG_PATTERN = (
    r'^([^ ]*) ([^ ]*) ([^ ]*) \[([^\]]*)\] "(\S+)(?: +([^"]*?)(?: +\S*)?)?" ([^ ]*) ([^ ]*)'
    r'( "([^"]*)" "([^"]*)")?'
    r'(?:\s+protocol=([^\s]+)\s+port=(\d+)\s+request_type=([^\s]+))?$'
)
# The same language for texts without stray quotes, in linear time: the plain request part has three
# neighbouring repeats that all take spaces. Here every repeat keeps what it has read, and a run of
# spaces belongs to the path unless only one more word stands before the closing quote.
ACCESS_LOG_PATTERN_LINEAR = ACCESS_LOG_PATTERN.replace(
    r'"(\S+)(?: +([^"]*?)(?: +\S*)?)?"',
    r'"([^\s"]++)(?: ++([^ "]*+(?: ++(?![^\s"]*+")[^ "]*+)*+)(?: ++[^\s"]*+)?+)?+"',
)
ACCESS_LOG_GROUPS = (
    "remote", "host", "user", "time", "method", "path", "code", "size",
    "tail", "referer", "agent", "protocol", "port", "request_type",
)
ACCESS_LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
EVENT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
LOG_TYPE = "nginx_access"
DEFAULT_PROTOCOL, DEFAULT_PORT, DEFAULT_REQUEST_TYPE = "TCP", 80, "HTTP"

# --- fixed values: model input, in model order -------------------------------
FEATURE_NAMES = (
    "Port", "Request_Type", "Protocol", "Payload_Size",
    "requests_per_ip", "failure_rate_per_ip", "avg_payload_per_ip", "payload_std_per_ip",
    "time_since_last_request", "inter_arrival_std",
    "ua_is_empty", "ua_is_tool", "ua_is_browser",
    "is_encrypted", "is_failure", "protocol_error_rate",
)
SCALED_FEATURES = (
    "Payload_Size", "avg_payload_per_ip", "payload_std_per_ip",
    "time_since_last_request", "inter_arrival_std",
)

# --- fixed values: labels and score constants --------------------------------
HIGH_RATE, HIGH_ERRORS, SUSPICIOUS_AGENT = (
    "high_request_rate", "high_error_ratio", "suspicious_user_agent",
)
BOT_AGENT, EMPTY_AGENT, NON_BROWSER = "bot_user_agent", "empty_user_agent", "non_browser_ua"
BOT_CLASS, NORMAL_CLASS, UNKNOWN_CLASS = "BotAttack", "Normal", "Unknown"
MODEL_METHOD, RULE_METHOD, UNKNOWN_METHOD = "ml_model", "rule_based", "unknown"
TOOL_AGENT_SCORE, EMPTY_AGENT_SCORE = 0.8, 0.6
FALLBACK_THRESHOLD = 0.5
REASON_FLOOR = 0.5
FREQUENT_REQUESTS = 10
