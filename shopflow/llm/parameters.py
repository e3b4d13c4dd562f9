"""Production parameters of the registered queries."""

# Host rules, (action, host and path prefix).
HOST_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

# Pages without prose, by any part of the URL; ``*`` stands for anything, ``|`` for the edge
# of a word.
WILDCARD_RULES = [
    *[("block", f"/{page}|") for page in ("login", "signup", "cart", "checkout", "wp-admin", "ads")],
    ("block", "?sessionid="),
    ("block", "&sessionid="),
    ("block", "/search?*q="),
    ("allow", "/search/help/"),
]

# Spam and advertising, by whole words of a host's labels.
SPAM_WORDS = ["adult", "casino", "bets", "pills", "porn", "viagra", "ads"]
WILDCARD_RULES += [
    ("block", begin + word + end)
    for word in SPAM_WORDS for begin, end in [("://", "-"), ("://", "."), (".", "-"), (".", "."), ("-", ".")]]
WILDCARD_RULES += [("block", f"|{words}|") for words in ("spam-farm", "link-farm")]
WILDCARD_RULES += [("allow", f"|{words}|") for words in ("adult-education", "adult-learning", "adult-literacy")]

# A document is kept from this score on.
QUALITY_CUT = 0.3
