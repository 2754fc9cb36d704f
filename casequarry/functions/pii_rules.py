"""Personal-data rules as data. Adding a recogniser means adding a row."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Rule:
    type: str
    regex: str
    confidence: float = 1.0
    stage: str = "regex"
    ignore_case: bool = False
    table: str | None = None      # only for this source table
    fields: tuple[str, ...] = ()  # only for these fields
    guard: str | None = None      # cheap regex that matches every text with a hit
    words: tuple[str, ...] = ()   # or lower-case words of which a hit has one
    token: str | None = None      # replacement, for the one-after-the-other engines


# The patterns, types, confidences, stages and tokens below must
# equal the published rules for results to agree.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
IPV4 = r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
IPV6 = r"\b(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}\b"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
DIGIT, HEX_PAIRS = r"\p{Nd}", r"[0-9A-Fa-f][:-][0-9A-Fa-f]"
PHONE_LOOSE = r"(\+\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"

# Own choice: pre-test words, see Rule.words.
CLOSINGS = ("regards", "sincerely", "thank")
TITLES = ("vp of", "senior", "director", "manager", "engineer")

STAGED = [
    Rule("EMAIL", EMAIL, guard="@"),
    Rule("PHONE", r"\b\+?1?[-.\s]?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}\b",
         guard=DIGIT),
    Rule("PHONE", r"\b\+[0-9]{1,3}[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,9}\b", guard=r"\+"),
    Rule("IP_ADDRESS", IPV4, guard=DIGIT),
    Rule("IP_ADDRESS", IPV6, guard=":"),
    Rule("MAC_ADDRESS", r"\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b", guard=HEX_PAIRS),
    Rule("SSN", SSN, guard=DIGIT),
    Rule("CREDIT_CARD", r"\b[0-9]{4}[-\s]?[0-9]{4}[-\s]?[0-9]{4}[-\s]?[0-9]{3,4}\b", 0.9,
         guard=DIGIT),
    Rule("EMAIL_SIGNATURE", r"(Best regards|Regards|Sincerely|Thanks|Thank you)[,\n][\s\S]*",
         0.85, "signature", True, "emailmessage", words=CLOSINGS),
    Rule("EMAIL_SIGNATURE", r"(VP of|Senior|Director|Manager|Engineer)[,\s]+[\w\s]+\n",
         0.85, "signature", True, "emailmessage", words=TITLES),
    Rule("SITE_ADDRESS", r"\b\d+\s+[A-Z][a-z]+\s+(Street|St|Avenue|Ave|Road|Rd|Drive|Dr|Lane|Ln"
         r"|Way|Boulevard|Blvd|Court|Ct)[,\s]", 0.8, "address", True, "workorder", guard=DIGIT),
    Rule("SITE_ADDRESS", r"Building\s+\d+", 0.8, "address", True, "workorder", guard=DIGIT),
    Rule("SITE_ADDRESS", r"\b[A-Z][a-z]+,\s+[A-Z]{2}\s+\d{5}\b", 0.8, "address", False,
         "workorder", guard=DIGIT),
    Rule("EMPLOYEE_ID", r"\bEMP_\d{5,}\b", 1.0, "custom_hpe", guard="EMP_"),
    Rule("EMPLOYEE_ID", r"\bHPE-\d{5,}\b", 1.0, "custom_hpe", guard="HPE-"),
    Rule("PERSONAL_HOSTNAME", r"\b[a-z]+-[a-z]+-(?:pc|laptop|workstation|desktop)\b", 0.75,
         "custom_hpe", True, guard="-"),
]

FLAT = [
    Rule("email", EMAIL, ignore_case=True, guard="@"),
    Rule("phone", PHONE_LOOSE, ignore_case=True, guard=DIGIT),
    Rule("ipv4", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", ignore_case=True, guard=DIGIT),
    Rule("ipv6", IPV6, ignore_case=True, guard=":"),
    Rule("serial_number", r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{6}\b", ignore_case=True, guard=DIGIT),
    Rule("credit_card", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", ignore_case=True,
         guard=DIGIT),
    Rule("ssn", r"\b\d{3}-\d{2}-\d{4}\b", ignore_case=True, guard=DIGIT),
]

SEQUENTIAL = [
    Rule("email", EMAIL, ignore_case=True, token="[EMAIL_REDACTED]", guard="@"),
    Rule("phone", r"(\+?1[-.\s]?)?\(?([0-9]{3})\)?[-.\s]?([0-9]{3})[-.\s]?([0-9]{4})",
         ignore_case=True, token="[PHONE_REDACTED]", guard=DIGIT),
    Rule("phone_intl", r"\+[0-9]{1,3}[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,4}[-.\s]?[0-9]{1,9}",
         ignore_case=True, token="[PHONE_REDACTED]", guard=DIGIT),
    Rule("ipv4", IPV4, token="[IP_REDACTED]", guard=DIGIT),
    Rule("ipv6", r"\b(?:[A-F0-9]{1,4}:){7}[A-F0-9]{1,4}\b", ignore_case=True, token="[IP_REDACTED]",
         guard=":"),
    Rule("mac_address", r"\b(?:[0-9A-F]{2}[:-]){5}[0-9A-F]{2}\b", ignore_case=True,
         token="[MAC_REDACTED]", guard=HEX_PAIRS),
    Rule("ssn", SSN, token="[SSN_REDACTED]", guard=DIGIT),
    Rule("credit_card", r"\b[0-9]{4}[-\s]?[0-9]{4}[-\s]?[0-9]{4}[-\s]?[0-9]{4}\b",
         token="[CC_REDACTED]", guard=DIGIT),
    Rule("employee_id", r"\b(EMP|HPE|emp)[_-]?[0-9]{5,8}\b", ignore_case=True,
         token="[EMPID_REDACTED]", guard=DIGIT),
]

SIGNATURES = [
    Rule("email_signature", r"(Best regards|Regards|Sincerely|Thanks|Thank you),?\s*\n+"
         r"[A-Z][a-z]+\s+[A-Z][a-z]+\s*\n+.*?(Engineer|Support|Team|Specialist)",
         ignore_case=True, token="[SIGNATURE_REDACTED]", words=CLOSINGS),
    Rule("email_footer", r"(--+|\n{2,})(.*?@.*?\.(com|net|org))", ignore_case=True,
         token="[FOOTER_REDACTED]", guard="@"),
]

SITES = [
    Rule("street_address", r"\b\d+\s+[A-Z][a-z]+(\s+[A-Z][a-z]+)*\s+(Street|St|Avenue|Ave|Road|Rd"
         r"|Boulevard|Blvd|Drive|Dr|Lane|Ln|Way|Court|Ct|Circle|Cir|Place|Pl)",
         ignore_case=True, token="[ADDRESS_REDACTED]", guard=DIGIT),
    Rule("customer_site", r"(Customer Site|Site|Location|Address):\s*[^\n]{10,100}",
         ignore_case=True, token="$1: [SITE_REDACTED]", guard=":"),
]

OWN_NAMES = [
    Rule("hpe_email", r"\b[A-Za-z0-9._%+-]+@(hpe\.com|hp\.com|aruba\.com)\b", ignore_case=True,
         token="[HPE_EMAIL_REDACTED]", guard="@"),
    Rule("personal_hostname", r"\b[a-z]+-[a-z]+-(?:pc|laptop|server|workstation)\b",
         ignore_case=True, token="[HOSTNAME_REDACTED]", guard="-"),
]

ONSITE = ("onsite_action", "problem_description")
BY_FIELD = [
    Rule("email", EMAIL, token="[EMAIL_REDACTED]", guard="@"),
    Rule("phone", PHONE_LOOSE, token="[PHONE_REDACTED]", guard=DIGIT),
    Rule("ipv4", r"\b(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}"
         r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\b", token="[IP_REDACTED]", guard=DIGIT),
    Rule("serial_number", r"\bSN:?\s*[A-Z0-9]{8,}\b", ignore_case=True,
         fields=(*ONSITE, "commentbody"), token="[SERIAL_REDACTED]", words=("sn",)),
    Rule("street_address", r"\b\d+\s+[A-Z][a-z]+\s+(Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd)\b",
         ignore_case=True, fields=ONSITE, token="[ADDRESS_REDACTED]", guard=DIGIT),
    Rule("email_signature", r"(Best regards|Regards|Sincerely|Thanks),?\s*\n[A-Z][a-z]+\s+[A-Z][a-z]+",
         ignore_case=True, token="[SIGNATURE_REDACTED]", words=CLOSINGS),
]

# Three patterns of the leak check.
LEAK = [
    Rule("email", EMAIL, guard="@"),
    Rule("phone", PHONE_LOOSE, guard=DIGIT),
    Rule("ipv4", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", guard=DIGIT),
]

RULESETS: dict[str, list[Rule]] = {
    "staged": STAGED, "flat": FLAT, "sequential": SEQUENTIAL, "signatures": SIGNATURES,
    "sites": SITES, "own_names": OWN_NAMES, "by_field": BY_FIELD, "leak": LEAK,
}

TOKENS = {
    "EMAIL": "[EMAIL_REDACTED]",
    "PHONE": "[PHONE_REDACTED]",
    "IP_ADDRESS": "[IP_REDACTED]",
    "MAC_ADDRESS": "[MAC_REDACTED]",
    "SSN": "[SSN_REDACTED]",
    "CREDIT_CARD": "[CC_REDACTED]",
    "PERSON_NAME": "[NAME_REDACTED]",
    "EMAIL_SIGNATURE": "[SIGNATURE_REDACTED]",
    "SITE_ADDRESS": "[ADDRESS_REDACTED]",
    "EMPLOYEE_ID": "[EMPID_REDACTED]",
    "PERSONAL_HOSTNAME": "[HOSTNAME_REDACTED]",
}
OTHER_TOKEN = "[REDACTED]"

# Words that no person name holds, risk tiers, high-risk tables and fields, keywords.
TECH_TERMS = ["ProLiant", "Synergy", "Aruba", "Gen10", "iLO", "SimpliVity", "Primera", "Nimble",
              "Apollo", "HPE"]

TABLE_RISK = {"case": "MEDIUM", "task": "LOW", "workorder": "HIGH", "casecomment": "HIGH",
              "workorderfeed": "MEDIUM", "emailmessage": "CRITICAL"}
HIGH_RISK_TABLES = ["emailmessage", "casecomments", "workorder"]
HIGH_RISK_FIELDS = ["commentbody", "textbody", "onsite_action", "problem_description",
                    "email_subject"]

CONFIDENTIAL_WORDS = ["confidential", "proprietary", "trade secret", "password", "secret",
                      "credential"]


def rules_frame(spark: SparkSession, rulesets: dict[str, list[Rule]] = RULESETS) -> DataFrame:
    """The rules as a table, for review and for storing user-added ones."""
    rows = [{"ruleset": name, "rule_no": number, **asdict(rule), "fields": list(rule.fields),
             "words": list(rule.words)}
            for name, rules in rulesets.items() for number, rule in enumerate(rules)]
    return spark.createDataFrame(
        rows, "ruleset string, rule_no int, type string, regex string, confidence double, "
        "stage string, ignore_case boolean, table string, fields array<string>, guard string, "
        "words array<string>, token string")


def rules_from_frame(frame: DataFrame, ruleset: str, limit: int = 1000) -> list[Rule]:
    """Rules read back in order; a rule table is small, which is checked."""
    rows = frame.filter(frame.ruleset == ruleset).orderBy("rule_no").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"ruleset {ruleset} has more than {limit} rules")
    return [Rule(r["type"], r["regex"], r["confidence"], r["stage"], r["ignore_case"], r["table"],
                 tuple(r["fields"] or ()), r["guard"], tuple(r["words"] or ()), r["token"]) for r in rows]


def with_rules(base: Iterable[Rule], *added: Rule) -> list[Rule]:
    """A ruleset with user-added recognisers at the end."""
    return [*base, *added]
