"""Patterns and word lists of the text scans, as Java regular expressions.

Word, digit and space classes are the Unicode ones. Word boundaries are written out because Java's
own ``\\b`` uses another word class.
"""

W = r"[\p{L}\p{N}_]"
S = r"\p{IsWhite_Space}\x1c-\x1f"
B = rf"(?:(?<={W})(?!{W})|(?<!{W})(?={W}))"
END = r"(?=\n?\z)"
I = "(?iu)"

EXEMPT = (
    r"^sha256:[0-9a-f]{64}\z",
    r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}T\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}(?:\.\p{Nd}+)?Z\z",
)

# Every control or bidirectional character is outside this class.
ORDINARY = r"[^\t\n\r -~]"
CONTROL_OR_BIDI = (
    r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\u200b-\u200f\u202a-\u202e\u2060\u2066-\u2069\ufeff]"
)

# Each scan pattern stands beside the literals of which its text must hold at least one; the literal
# test is far cheaper than the expression, and no literal depends on letter case. Where no such literal is known, a third
# entry has words of which the text must hold one once its letter case is folded.
SECRETS = (
    (("-----",), rf"{I}-----BEGIN (?:[A-Z0-9 ]+ )?PRIVATE KEY-----"),
    (("_",), rf"(?<!{W})(?:gh[pousr]_[A-Za-z0-9]{{20,}}|github_pat_[A-Za-z0-9_]{{20,}})(?!{W})"),
    (("AKIA",), rf"(?<!{W})AKIA[0-9A-Z]{{16}}(?!{W})"),
    ((), rf"{I}(?<!{W})Bearer[{S}]+[A-Za-z0-9._~+/=-]{{10,}}{B}", ("bearer",)),
    (("eyJ",), rf"(?<!{W})eyJ[A-Za-z0-9_-]{{4,}}\.[A-Za-z0-9_-]{{4,}}\.[A-Za-z0-9_-]{{4,}}{B}"),
    ((":", "="), rf"{I}(?<!{W})(?:password|passwd|secret|token|client_secret)[{S}]*[:=][{S}]*[^{S}]", ("passw", "secret", "token")),
    (("://",), rf"{I}[a-z][a-z0-9+.-]*://[^{S}/:@]+:[^{S}/@]+@"),
)
LOCATORS = (
    (("@",), rf"{I}git@"),
    (("://",), rf"{I}ssh://"),
    ((), rf"{I}(?:^|/)\.git(?:/|{END})", (".git",)),
)
PATHS = (
    ((":\\",), rf"{I}(?:^|[{S}])[A-Za-z]:\\(?:Users|Windows|ProgramData|private|home)\\"),
    (("/",), rf"{I}(?:^|[{S}('])/(?:home|Users|root|etc|var|srv|opt|mnt|private)/"),
    ((":\\",), r"^[A-Za-z]:\\"),
    (("..",), rf"(?:^|[/\\])\.\.(?:{END}|[/\\])"),
)
PATH_STARTS = ("/", "~/", "file:///")

# Every account number and telephone number holds nine digits with at most one separator between.
NINE_DIGITS = r"\p{Nd}(?:[ .-]?\p{Nd}){8}"
ACCOUNT = rf"{I}(?<![0-9a-f])\p{{Nd}}{{12}}(?![0-9a-f])"
EMAIL = ("@",), r"(?<![\p{L}\p{N}_.+-])[\p{L}\p{N}_.+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?![\p{L}\p{N}_.-])"
PHONE = r"(?<!\p{Nd})(?:\+\p{Nd}{1,3}[ .-]?)?(?:\p{Nd}[ .-]?){9,14}(?!\p{Nd})"
STRUCTURED_ID = ("-", "_"), rf"{I}(?<!{W})(?:account|customer|cust|project|subscription|tenant)[-_][A-Za-z0-9]{{4,}}(?!{W})", (
    "account", "cust", "project", "subscription", "tenant",
)

VULNERABILITY = (
    rf"{I}(?:exploit[{S}]+(?:code|command)|reproduction[{S}]+command"
    rf"|vulnerable[{S}]+private[{S}]+endpoint|attack[{S}]+prerequisite)"
)
VULNERABILITY_WORDS = ("exploit", "reproduction", "vulnerable", "attack")

HOST_STRIP = "[](){}<>,.;'\" "
HOST_TOKEN = r"\[?[0-9a-fA-F:.]+\]?|[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++|localhost"
HOST_NAMES = ("localhost", "instance-data", "metadata.google.internal")
HOST_SUFFIXES = (".localhost", ".internal", ".local", ".lan")
# Every text that can hold a flagged host holds one of the literals or matches the expression; cheap
# tests before the tokens are cut out.
HOST_LITERALS = ("localhost", "://")
HOST_HINT = r"\.(?i:internal|local|lan)|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|:[0-9a-fA-F.]*:"
IPV4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\z"
IPV6_SHAPE = r"^[0-9a-f.]*:[0-9a-f:.]*:[0-9a-f:.]*\z"
# Networks that are not globally routable, and the exceptions inside them.
IPV4_SPECIAL = (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24",
    "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4",
)
IPV4_GLOBAL_EXCEPTIONS = ("192.0.0.9/32", "192.0.0.10/32")
IPV6_SPECIAL = (
    "::/128", "::1/128", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16",
    "fc00::/7", "fe80::/10",
)
IPV6_GLOBAL_EXCEPTIONS = (
    "2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48", "2001:20::/28", "2001:30::/28",
)
IPV6_MAPPED_IPV4 = "::ffff:0:0/96"

# Second, narrower scan: name -> pattern.
PRIVATE_TEXT = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "cloud_key": r"AKIA[0-9A-Z]{16}",
    "posix_path": rf"(?:^|[{S}'\"])/(?:home|Users|root|tmp)/",
    "drive_path": r"[A-Za-z]:\\",
    "internal_host": rf"{I}{B}(?:localhost|[A-Za-z0-9-]+\.internal)(?!{W})",
    "customer_id": rf"{I}(?<!{W})customer(?:[_ -]?(?:id|identifier))?[{S}]*[:=][{S}]*[^{S}]",
    "credential": rf"{I}(?<!{W})(?:password|credential|secret|token)[{S}]*[:=][{S}]*[^{S}]",
    "email": rf"{I}{B}[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{{2,}}(?!{W})",
    "phone": rf"(?:\+\p{{Nd}}{{8,15}}|(?<!{W})\p{{Nd}}{{2,4}}[- )]\p{{Nd}}{{2,4}}[- ]\p{{Nd}}{{3,4}}(?!{W}))",
    "tenant_id": (
        rf"{I}(?<!{W})(?:tenant|account|organization|org|user)(?:[_ -]?(?:id|identifier))?[{S}]*[:=][{S}]*[^{S}]"
    ),
    "hosted_repository": rf"{I}(?<!{W})(?:github\.com|gitlab\.com)/[^/{S}]+/[^/{S}]",
}
# Literals of which a text must hold one for a pattern of the second scan to be worth running.
PRIVATE_TEXT_NEEDS = {
    "private_key": ("-----BEGIN",), "cloud_key": ("AKIA",), "posix_path": ("/",), "drive_path": (":\\",),
    "customer_id": (":", "="), "credential": (":", "="), "email": ("@",), "tenant_id": (":", "="), "hosted_repository": ("/",),
}

PROHIBITED_VERBS = r"(?:proves?|certif(?:y|ies|ied|ication))"

SENSITIVE_CLASSES = (
    "control-or-bidi-character", "private-key-or-token", "private-repository-locator", "internal-host-or-address",
    "account-identifier", "customer-or-personal-identifier", "raw-vulnerability-detail",
)
