"""Fixed values.

Everything in this module is data that results depend on: word lists, patterns,
thresholds and labels. They are kept together and in their natural order so a
reader can check them at a glance. Larger dictionaries (component taxonomy,
keyword lists) are tables that the caller passes in.
"""

# --- URLs ------------------------------------------------------------------

# Query parameters that never identify a page (full canonical form).
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid", "msclkid", "ref", "source", "mc_cid", "mc_eid",
]

# The light form keeps msclkid.
LIGHT_TRACKING_PARAMS = [p for p in TRACKING_PARAMS if p != "msclkid"]

# Second-level labels below which a registered domain has three labels.
SECOND_LEVEL_LABELS = ["co", "com", "org", "net", "gov", "edu"]

# Path templates, applied in this order.
PATH_TEMPLATES = [
    (r"/\d+/?", "/{id}/"),
    (r"/[a-f0-9-]{36}/?", "/{uuid}/"),
    (r"(?i)/[a-z0-9-]{10,}/?$", "/{slug}/"),
]

LISTING_URL_PATTERNS = [
    r"/page/\d+/?$", r"/category/", r"/tag/", r"/author/", r"/search\?", r"\?page=",
]

MEDIA_URL_PATTERNS = [
    r"/media/", r"/attachment", r"/uploads/", r"/images/",
    r"\.(jpg|jpeg|png|gif|webp|pdf|mp4|mp3)$",
]

# Link families for item discovery and the paths they skip.
ITEM_LINK_PATTERNS = {
    "listing": [
        r'href="([^"]*(?:/vehicle/|/listing/|/item/|/detail/)[^"]*)"',
        r'href="([^"]*/inventory/\d+[^"]*)"',
    ],
    "auction": [
        r'href="([^"]*(?:/listing/|/lot/|/auction/|/vehicle/)\d+[^"]*)"',
        r'href="([^"]*(?:/sold/|/completed/)\d+[^"]*)"',
    ],
    "gallery": [r'href="([^"]*(?:/gallery/|/portfolio/|/project/|/build/|/vehicle/)[^"]*)"'],
}
GALLERY_SKIP = [
    "/wp-", "/tag/", "/category/", "/author/", "/feed/", "/comments/", "/trackback/",
    ".jpg", ".png", ".gif",
]

PLACEHOLDER_IMAGE = r"(?i)placeholder|no-image|noimage|default|missing|blank\.|1x1\.|spacer|transparent"

# --- text ------------------------------------------------------------------

EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
URL_IN_TEXT = r"https?://[^\s<>\"']+"

SECRET_PATTERNS = [
    (r"authorization:\s*bearer\s+[^\s]+", "authorization: bearer [REDACTED]"),
    (r"cookie:\s*[^\r\n]+", "cookie: [REDACTED]"),
    (r"set-cookie:\s*[^\r\n]+", "set-cookie: [REDACTED]"),
    (r"x-api-key:\s*[^\s]+", "x-api-key: [REDACTED]"),
    (r"proxy-authorization:\s*[^\s]+", "proxy-authorization: [REDACTED]"),
    (r"api[_-]?key[\"']?\s*[:=]\s*[\"']?[^\s\"']+", "api_key: [REDACTED]"),
    (r"token[\"']?\s*[:=]\s*[\"']?[^\s\"']+", "token: [REDACTED]"),
    (r"secret[\"']?\s*[:=]\s*[\"']?[^\s\"']+", "secret: [REDACTED]"),
    (r"password[\"']?\s*[:=]\s*[\"']?[^\s\"']+", "password: [REDACTED]"),
]
SECRET_KEYS = ["authorization", "cookie", "api-key", "apikey", "token", "secret", "password"]

GARBAGE_PATTERNS = [
    r"^(null|none|undefined|n/a|na|tbd|test|xxx|asdf)$",
    r"^[\W\d]+$",
    r"^.{0,2}$",
    r"^lorem\s+ipsum",
    r"^placeholder",
    r"^(string|object|array|error)$",
]

ANSI_ESCAPE = r"\x1B(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])"

NEGATIVE_INDICATORS = ["no", "not", "cannot", "don't", "doesn't", "missing", "absent", "fail"]
POSITIVE_INDICATORS = ["yes", "visible", "present", "found", "correct", "matches"]

PROVIDERS = [("claude", "anthropic"), ("gemini", "google"), ("palm", "google"), ("gpt", "openai")]

# --- pages -----------------------------------------------------------------

ERROR_PATTERNS = [
    (r"\b403\s*(forbidden|error)?\b", "http_403"),
    (r"\b404\s*(not\s*found|error)?\b", "http_404"),
    (r"\b500\s*(internal\s*server|error)?\b", "http_500"),
    (r"\b502\s*(bad\s*gateway)?\b", "http_502"),
    (r"\b503\s*(service\s*unavailable)?\b", "http_503"),
    (r"cloudflare", "cloudflare_blocked"),
    (r"please\s+enable\s+(javascript|cookies)", "js_required"),
    (r"captcha|recaptcha|hcaptcha", "captcha"),
    (r"access\s+denied", "access_denied"),
    (r"blocked|firewall|waf", "blocked"),
    (r"rate\s*limit(ed)?", "rate_limited"),
    (r"too\s+many\s+requests", "rate_limited"),
    (r"bot\s+detection|suspicious\s+activity", "bot_detected"),
    (r"ddos[\-\s]protection", "ddos_protection"),
    (r"page\s*(not\s*found|removed|deleted)", "page_removed"),
    (r"(listing|item|vehicle)\s*(no\s*longer|has\s*been)\s*(available|sold|removed)", "listing_removed"),
    (r"this\s+(page|listing)\s+(doesn.t|does\s*not)\s*exist", "page_removed"),
    (r"(please\s+)?(log\s*in|sign\s*in)\s+(to\s+(view|access|continue)|required)", "login_required"),
    (r"members?\s+only", "login_required"),
    (r"coming\s+soon", "placeholder"),
    (r"under\s+construction", "placeholder"),
]
ERROR_PAGE_LABELS = 3
TINY_PAGE_BYTES = 500
SMALL_PAGE_BYTES = 2000

BLOCK_STATUS_CODES = [403, 429, 503, 520, 521, 522, 523, 524]
BLOCK_PHRASES = [
    "access denied", "access forbidden", "rate limit", "too many requests", "cloudflare",
    "please complete the security check", "captcha", "recaptcha", "hcaptcha", "verify you are human",
]
BLOCK_PHRASES_SHORT = [
    "access denied", "rate limit", "too many requests", "cloudflare",
    "please complete the security check", "captcha", "blocked", "forbidden",
]
CLOUDFLARE_HEADERS = ["cf-ray", "cf-cache-status", "cf-request-id"]

# (block type, phrases that must all occur, indicator text), in order of precedence.
BLOCK_CHECKS = [
    ("cloudflare", ["cloudflare", "challenge"], "Cloudflare challenge page"),
    ("cloudflare", ["ray id", "cloudflare"], "Cloudflare Ray ID"),
    ("cloudflare", ["cf-browser-verification"], "Cloudflare browser verification"),
    ("cloudflare", ["challenge-platform"], "Cloudflare challenge platform"),
    ("cloudflare", ["just a moment", "cloudflare"], "Cloudflare 'Just a moment' page"),
    ("captcha", ["captcha"], "CAPTCHA detected"),
    ("captcha", ["recaptcha"], "reCAPTCHA detected"),
    ("captcha", ["hcaptcha"], "hCaptcha detected"),
    ("captcha", ["verify you are human"], "Human verification required"),
    ("access_denied", ["access denied"], "Access denied message"),
    ("access_denied", ["access forbidden"], "Access forbidden message"),
    ("access_denied", ["blocked", "ip"], "IP blocked message"),
    ("access_denied", ["please enable javascript"], "JavaScript verification required"),
    ("access_denied", ["checking your browser"], "Browser check in progress"),
    ("ddos_protection", ["ddos protection"], "DDoS protection active"),
    ("ddos_protection", ["bot detection"], "Bot detection triggered"),
]

BLOCK_ADVICE = {
    "cloudflare": "Fetch with a full browser, rotate the session and raise the delay.",
    "captcha": "Needs a person or a solving service.",
    "rate_limit": "Raise the delay to 5-10 seconds and rotate the session.",
    "ddos_protection": "Wait at least 5 minutes, then fetch with a full browser.",
}
BLOCK_ADVICE_DEFAULT = "Rotate the address or session and raise the delay."

CHALLENGE_PATTERNS = [
    r"<title>Just a moment\.\.\.</title>", r"cloudflare\.com/cdn-cgi/challenge-platform",
    r"cf-chl-bypass", r"cf_chl_opt", r"turnstile\.cloudflare\.com", r"challenges\.cloudflare\.com",
    r"Checking your browser", r"Enable JavaScript and cookies", r"Verify you are human",
]
TURNSTILE_PATTERNS = [r"cf-turnstile", r"turnstile/v0/api\.js", r"challenges\.cloudflare\.com/turnstile"]

NEXT_PAGE_PATTERNS = [
    r'class="[^"]*next[^"]*"[^>]*href', r'rel="next"', r'aria-label="[Nn]ext"', r">\s*Next\s*<", r">\s*›\s*<",
]
NEXT_LINK_PATTERNS = [
    r"<a[^>]*rel=[\"']next[\"'][^>]*href=[\"']([^\"']+)[\"']",
    r"<a[^>]*href=[\"']([^\"']+)[\"'][^>]*rel=[\"']next[\"']",
    r"<a[^>]*class=[\"'][^\"']*next[^\"']*[\"'][^>]*href=[\"']([^\"']+)[\"']",
]
PAGE_LINK = r"(?i)<a[^>]*href=[\"']([^\"']*[?&]page=(\d+)[^\"']*)[\"']"
INFINITE_SCROLL_PATTERNS = [r"infinite[-_]?scroll", r"data-infinite", r"loadMore", r"load[-_]?more"]
LOAD_MORE_PATTERNS = [
    r"<button[^>]*>[^<]*load\s*more[^<]*</button>", r"<a[^>]*>[^<]*load\s*more[^<]*</a>",
    r"class=[\"'][^\"']*load[-_]?more[^\"']*[\"']",
]

LOT_ATTRIBUTES = {
    "lot_number": r'data-lot="(\d+)"',
    "price": r'data-price="([^"]*)"',
    "status": r'data-status="([^"]*)"',
}

# --- records ---------------------------------------------------------------

REQUIRED_FIELDS = [
    "build_id", "source_type", "build_type", "build_source", "source_url", "year", "make", "model",
]
SOURCE_TYPES = ["listing", "auction", "build_thread", "project", "gallery", "article"]
SALE_SOURCE_TYPES = ["listing", "auction"]
BUILD_TYPES = [
    "OEM+", "Street", "Track", "Drift", "Rally", "Time Attack", "Drag", "Show",
    "Restomod", "Restoration", "Pro Touring", "Overland", "Off-Road", "Rock Crawler",
    "Prerunner", "Trophy Truck", "Lowrider", "Stance", "VIP", "Bosozoku", "Rat Rod",
    "Hot Rod", "Muscle", "Classic", "Modern Classic", "JDM", "Euro", "USDM",
    "Daily Driver", "Weekend Warrior", "Work Truck", "Tow Rig",
]
TRANSMISSIONS = ["Manual", "Automatic", "DCT", "CVT", "Sequential"]
DRIVETRAINS = ["RWD", "FWD", "AWD", "4WD"]
MOD_LEVELS = ["Stock", "Lightly Modified", "Moderately Modified", "Heavily Modified"]
VIN = r"^[A-HJ-NPR-Z0-9]{17}$"

# Category names as audits accept them, lower-cased.
AUDIT_CATEGORIES = [
    "engine", "suspension", "wheels/tires", "wheels", "tires", "exterior", "interior", "exhaust",
    "brakes", "electrical", "drivetrain", "cooling", "body", "lighting", "performance", "audio",
    "intake", "turbo", "supercharger", "fuel", "transmission", "differential", "steering", "safety",
    "aero", "aerodynamics", "other", "wheel", "brake & wheel hub", "exhaust & emission",
]
# Category names as the extraction audit and the stage gate accept them, exact case.
STANDARD_CATEGORIES = [
    "Forced Induction", "Oil", "Wheel", "Safety", "Lighting", "Storage", "Recovery",
    "Armor/Protection", "Suspension", "Fuel & Air", "Brake & Wheel Hub", "Engine",
    "Exhaust & Emission", "Interior", "Drivetrain", "Transmission-Manual",
    "Transmission-Automatic", "Electrical", "Cooling System", "Body & Lamp Assembly", "Steering",
    "Heat & Air Conditioning", "Ignition", "Belt Drive", "Wiper & Washer", "Aero", "Other",
]
KNOWN_MAKES = [
    "acura", "alfa romeo", "amc", "aston martin", "audi", "bentley", "bmw", "bugatti", "buick",
    "cadillac", "chevrolet", "chevy", "chrysler", "citroen", "datsun", "dodge", "ferrari", "fiat",
    "ford", "genesis", "gmc", "honda", "hummer", "hyundai", "infiniti", "isuzu", "jaguar", "jeep",
    "kia", "lamborghini", "land rover", "lexus", "lincoln", "lotus", "maserati", "mazda", "mclaren",
    "mercedes", "mercedes-benz", "mercury", "mini", "mitsubishi", "nissan", "oldsmobile", "opel",
    "pagani", "peugeot", "plymouth", "pontiac", "porsche", "ram", "renault", "rivian",
    "rolls-royce", "saab", "saturn", "scion", "seat", "shelby", "skoda", "smart", "subaru",
    "suzuki", "tesla", "toyota", "triumph", "vauxhall", "volkswagen", "vw", "volvo", "willys",
]

# Weights of the completeness score (sum 5.6).
COMPLETENESS_WEIGHTS = {
    "with_build_id": 1.0, "with_url": 1.0, "with_make": 1.0, "with_model": 1.0,
    "with_year": 0.5, "with_title": 0.3, "with_story": 0.3, "with_images": 0.5,
}
# Weights of the quality report.
QUALITY_WEIGHTS = {
    "url_validity": 0.15, "url_uniqueness": 0.1, "url_count": 0.1, "html_coverage": 0.2,
    "html_quality": 0.15, "build_completeness": 0.15, "build_confidence": 0.1, "build_count": 0.05,
}

# --- names and categories --------------------------------------------------

BRAND_PREFIX = (
    r"^(hks|trust|greddy|apexi|cusco|tein|bc racing|kw|bilstein|eibach|h&r|borla|magnaflow|flowmaster"
    r"|msd|edelbrock|holley|k&n|aem|injen|mishimoto|brembo|wilwood|apr|stoptech|hawk)\s+"
)
SIZE_SPEC = r"\d+(\.\d+)?\s*(mm|inch|\"|')?\s*"
FILLER_WORDS = (
    r"\b(kit|set|assembly|system|upgrade|performance|racing|sport|pro|series|v\d|mk\d|gen\d)\b"
)

# First match wins.
CATEGORY_PATTERNS = [
    ("Engine", [r"ecu", r"remap", r"tune", r"tuning", r"stage\s*\d", r"pulley", r"supercharger", r"turbo"]),
    ("Exhaust", [r"exhaust", r"cat\s*back", r"catback", r"downpipe", r"catalytic", r"sports?\s*cat", r"muffler", r"milltek"]),
    ("Intake", [r"intake", r"air\s*filter", r"cold\s*air", r"induction"]),
    ("Exterior", [r"carbon\s*fib", r"splitter", r"diffuser", r"wing", r"spoiler", r"bonnet", r"hood", r"side\s*skirt", r"grille", r"canard", r"fender", r"boot\s*lid"]),
    ("Suspension", [r"suspension", r"coilover", r"spring", r"lowering", r"damper", r"shock", r"strut"]),
    ("Wheels & Tires", [r"wheel", r"rim", r"tire", r"tyre", r"alloy"]),
    ("Interior", [r"interior", r"seat", r"steering\s*wheel", r"dash", r"trim", r"pedal"]),
    ("Cooling", [r"intercooler", r"radiator", r"coolant", r"cooling"]),
]
KNOWN_BRANDS = [
    "Milltek", "VIEZU", "Harrop", "KW", "H&R", "Akrapovic", "Paramount Performance", "Paramount", "BMC", "K&N",
]
DEFAULT_BRAND = "Paramount Performance"

LIST_ITEM_SKIP = ["click here", "visit", "order", "contact"]
PRODUCT_TERMS = ["exhaust", "remap", "tuning", "intake", "suspension", "intercooler", "carbon"]
HEADING_SKIP = ["presenting", "about", "choice is yours", "contact", "installation", "order", "dyno", "halo"]
HEADING_TERMS = ["carbon", "exhaust", "intake", "upgrades"]

# --- fetch errors ----------------------------------------------------------

# (class, phrases matched on the lower-cased message, patterns matched on the raw one), first match wins.
FETCH_ERROR_CLASSES = [
    ("dns", ["resolve", "nodename", "getaddrinfo"], None),
    ("timeout", ["timeout", "timed out"], None),
    ("blocked_403", [], "403"),
    ("blocked_429", [], "429"),
    ("cloudflare", ["cloudflare", "captcha"], None),
    ("server_5xx", [], "50[0-4]"),
    ("not_found", [], "404"),
    ("ssl", ["ssl", "certificate"], None),
    ("connection", ["connection", "connect"], None),
]
FETCH_ERROR_ADVICE = {
    "dns": "The site may be down or its domain changed; retry later.",
    "timeout": "Raise the timeout or add delays.",
    "blocked_403": "The site refuses the fetcher; use a full browser.",
    "blocked_429": "Wait longer between requests.",
    "cloudflare": "Needs a full browser.",
    "server_5xx": "The site has trouble; retry the failed URLs later.",
    "not_found": "Check how the URLs were discovered.",
    "ssl": "Check the certificates.",
    "connection": "Check the network and retry.",
    "other": "Read the messages.",
}
FETCH_ERROR_ADVICE_DEFAULT = "Unknown issue"

# (phrases, issue, severity): what a failure log points at.
LOG_SYMPTOMS = [
    (["403", "Forbidden"], "403 Forbidden errors", "HIGH"),
    (["429", "rate limit"], "Rate limiting detected", "HIGH"),
    (["timeout", "ETIMEDOUT"], "Request timeouts", "MEDIUM"),
    (["Cloudflare", "challenge"], "Cloudflare protection detected", "HIGH"),
]
# (phrases on the lower-cased log, category, summary), first match wins.
LOG_CATEGORIES = [
    (["403", "forbidden"], "blocked", "Access denied (403 Forbidden)"),
    (["429", "rate limit", "too many"], "rate_limit", "Rate limit exceeded (429)"),
    (["captcha", "challenge", "verify"], "captcha", "CAPTCHA or verification required"),
    (["timeout", "timed out"], "network", "Request timeout"),
    (["selector", "not found", "none"], "selector_change", "Selector/element not found"),
    (["cloudflare", "cf_"], "blocked", "Cloudflare protection detected"),
    (["login", "auth", "sign in"], "auth", "Authentication required"),
]
STATUS_ADVICE = {
    "blocked": "Raise the delays or change the address.",
    "error": "The site may have changed; analyse it again.",
    "hitl": "A person has to look at it.",
    "rate_limit": "Lower the request rate and back off.",
}
STATUS_ADVICE_DEFAULT = "Review the logs and the settings."

SUCCESS_MARKERS = r" Done!|<promise>COMPLETE</promise>"
CRITICAL_MARKERS = r"CRITICAL_FAILURE|Segmentation fault|FATAL ERROR"
ERROR_MARKERS = r"ERROR|FAIL|Exception"
SYSTEM_LINE_WORDS = ["iteration", "stage"]

# --- queue and pacing ------------------------------------------------------

STATUS_ORDER = ["in_progress", "pending", "blocked", "completed"]
UNRANKED = 99
DEFAULT_PRIORITY = 999
BACKOFF_START_S = 300
BACKOFF_MAX_S = 1800
STOP_AFTER_BLOCKS = 5
SESSION_PAGES = 50
STALL_MINUTES = 10
BODY_COMPRESS_BYTES = 10000
