"""Word lists and patterns of the rule-based extractors, with their weights."""

from __future__ import annotations

COUNTER = (
    r"\bbut\b", r"\bhowever\b", r"\balthough\b", r"\bthough\b", r"\bdespite\b", r"\byet\b", r"\bunfortunately\b",
    r"\bregardless\b", r"\bnot\b", r"\bno\b", r"\bopposed\b", r"\bagainst\b", r"\bcontary\b",
)

ARGUMENT = {
    r"\bbecause\b": 0.9,
    r"\btherefore\b": 0.85,
    r"\bconsequently\b": 0.85,
    r"\bas a result\b": 0.8,
    r"\bthe rationale\b": 0.9,
    r"\bthe justification\b": 0.9,
    r"\bhowever\b": 0.7,
    r"\bnevertheless\b": 0.75,
    r"\bon the other hand\b": 0.75,
    r"\bevidence\b": 0.8,
    r"\bstudies show\b": 0.85,
    r"\bresearch indicates\b": 0.85,
    r"\bdata suggests\b": 0.8,
    r"\bconcern(?:s)?\b": 0.75,
    r"\bobject(?:s|ion)?\b": 0.8,
    r"\bdisagree(?:s)?\b": 0.8,
    r"\bargument\b": 0.7,
    r"\bclaim\b": 0.7,
    r"\bassertion\b": 0.7,
    r"\bpremise\b": 0.75,
    r"\bconclusion\b": 0.8,
}

POSITION = (
    r"\bwe support\b", r"\bwe oppose\b", r"\bwe recommend\b", r"\bwe propose\b", r"\bwe call for\b", r"\bwe believe\b",
    r"\bsupports?\b", r"\bopposes?\b", r"\brecommends?\b", r"\bshould\b",
)

#: Two citation patterns with capital letters are left out: matched against lower-cased text they cannot fire.
EVIDENCE = {
    r"\bbecause\b": 0.9,
    r"\btherefore\b": 0.85,
    r"\bconsequently\b": 0.85,
    r"\bas a result\b": 0.8,
    r"\bthe rationale\b": 0.9,
    r"\bthe justification\b": 0.9,
    r"\bdata suggests\b": 0.85,
    r"\bevidence\b": 0.9,
    r"\bstudies show\b": 0.9,
    r"\bresearch indicates\b": 0.85,
    r"\bevidence suggests\b": 0.8,
    r"\baccording to\b": 0.88,
    r"\bstudy shows\b": 0.85,
    r"\bdata indicates\b": 0.82,
    r"\bresults indicate\b": 0.8,
    r"\bfindings suggest\b": 0.85,
    r"\bor observations show\b": 0.8,
    r"\bstudy \(.*\)\b": 0.9,
    r"\bwork by \w+\b": 0.88,
    r"\breference\s+\d+\)\b": 0.9,
    r"\bcitation\s+\d+\)\b": 0.85,
    r"\b%\s+": 0.85,
    r"\b\d+\s+figures\b": 0.88,
    r"\b\d+\(\d+\)\b": 0.9,
    r"\bstatistical analysis\b": 0.82,
    r"\bcorrelation analysis\b": 0.85,
    r"\bregression model\b": 0.88,
    r"\bmeta-analysis\b": 0.9,
    r"\bcomparative study\b": 0.8,
    r"\bstrong evidence\b": 0.8,
    r"\bcompelling data\b": 0.83,
    r"\bboxers ifields results\b": 0.88,
    r"\bconvincing finding\b": 0.9,
    r"\bnotable discovery\b": 0.95,
    r"\bempirical support\b": 0.9,
    r"\bor surprising outcome\b": 0.82,
    r"\bfinal note\b": 0.9,
}

ORGANISATION = (
    r"\b([A-Z][A-Za-z0-9&,. ]{2,50}(?:Society|Institute|Association|Council|Company|Inc|LLC|Corporation|University))\b"
)

MODALS = ("shall", "must", "should", "may", "will")
TEMPORAL = ("before", "after", "subsequently", "later", "finally", "initially")
NEGATIONS = ("however", "but", "although", "despite", "yet", "nevertheless")
OPPOSITIONS = ("argue", "claim", "suggest", "propose", "believe")
REASONS = ("because", "therefore", "thus", "hence")

#: Organisations with their type and other name, in order.
ORGANISATIONS = (
    ("ICANN", "internet_governance", "Internet Corporation for Assigned Names and Numbers"),
    ("IGF", "internet_governance", "Internet Governance Forum"),
    ("IETF", "technical_standards", "Internet Engineering Task Force"),
    ("ITU", "intergovernmental", "International Telecommunication Union"),
    ("UN", "intergovernmental", "United Nations"),
    ("UN DESA", "intergovernmental", "United Nations Department of Economic and Social Affairs"),
    ("UNESCO", "intergovernmental", "United Nations Educational, Scientific and Cultural Organization"),
    ("OECD", "intergovernmental", "Organisation for Economic Co-operation and Development"),
    ("ISOC", "civil_society", "Internet Society"),
    ("ARIN", "regional_internet_registry", "American Registry for Internet Numbers"),
    ("RIPE NCC", "regional_internet_registry", "Réseaux IP Européens Network Coordination Centre"),
    ("APNIC", "regional_internet_registry", "Asia-Pacific Network Information Centre"),
    ("LACNIC", "regional_internet_registry", "Latin America and Caribbean Network Information Centre"),
    ("AFRINIC", "regional_internet_registry", "African Network Information Centre"),
)

#: Negation of a claim: pattern and replacement, applied one after another, whatever the case.
NEGATE = (
    (r"\b(should|must|will|can)\b", r"not $1"),
    (r"\b(is|are|was|were)\b", r"$1 not"),
    (r"\b(support|approve|endorse|favor)\b", r"oppose $1"),
    (r"\b(oppose|reject|disapprove)\b", r"support $1"),
)

#: Phrases that disclose uncertainty.
UNCERTAIN = (
    "insufficient", "no evidence", "not enough", "cannot be verified", "cannot establish", "no retrieved source",
    "not established", "available evidence does not", "unclear",
)
