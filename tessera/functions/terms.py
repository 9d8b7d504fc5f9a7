"""Literal dictionaries and patterns used by the cleaning rules.

Everything in the FIXED VALUES block must equal the behaviour being
reproduced (class names, technical vocabulary, regex rules, slang table);
it is written out plainly, in its natural order.  Patterns are written in
Python `re` syntax; :func:`tessera.functions.regex.java` translates them
to the Java dialect Spark uses, and :func:`tessera.functions.regex.re2`
to the RE2 dialect DuckDB uses.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference behaviour exactly)
# ---------------------------------------------------------------------------

# Class index -> class name.
CLASSES = {
    0: "Sadness",
    1: "Joy",
    2: "Love",
    3: "Anger",
    4: "Fear",
    5: "Surprise",
}

# Technical / markup vocabulary for the context-window rule.  The original
# list fuses 'bottom' and 'style' through a missing comma; both words are
TECHNICAL_TERMS = (
    "html", "css", "xml", "php", "javascript", "js",
    "a_href", "n_href", "a_rel", "src", "rel", "alt", "link", "img", "div", "span", "script",
    "width", "height", "border", "margin", "padding", "px", "em", "data", "medium", "src", "img",
    "image", "top", "bottom",
    "style", "class", "type", "text", "application", "background", "color", "serif", "br",
    "adjust", "auto",
    "font", "size", "family", "annotation", "display", "indline", "new", "roman",
    "http", "https", "www", "url", "uri",
    "true", "false", "null", "target",
    "stylesheet", "templates", "pub", "message", "board",
    "vol", "en", "del", "fn",
    "atom", "ltr", "rtl", "utf",
    "titled", "title", "smarty", "jdelivery",
    "twitter", "provokingbeauty",
)

# A single trailing technical word is removed only when it is one of these.
ALWAYS_REMOVE_TRAILING = ("a_href", "n_href", "a_rel")

# Characters stripped from both ends of a word before the vocabulary test.
WORD_STRIP_CHARS = ".,!?;:"

# URL removal, applied in order, case-sensitive, replaced by ''.
URL_PATTERNS = (
    r"https?://[^\s]+",
    r"www\.[^\s]+",
    r"\bhttp\s+[^\s]*",
)

# Metadata blocks, applied in order, case-insensitive, replaced by ' '.
TECHNICAL_BLOCKS = (
    r"\bencoding\s+\w+(?:\s+locale\s+\w+)?",
    r"\blocale\s+\w{2}(?:[-_]\w{2})?",
    r"\bisprivate(?:blog)?\s+(?:true|false)",
    r"\bismobile\s+(?:true|false)",
    r"\bmobileclass\s+\w*",
    r"\blanguagedirection\s+(?:ltr|rtl)",
    r"\bfeedlinks\s+\w*",
    r"\blink\s+rel\s+\w+",
    r"\btype\s+application\s+[\w/]+\s+(?:xml)?",
)

# Bigram fusing, applied in order, case-insensitive.
BIGRAMS = (
    (r"\ba\s+href\b", "a_href"),
    (r"\ba\s+rel\b", "a_rel"),
    (r"\bn\s+href\b", "n_href"),
)

# Tokens containing 'href' left after the window rule, case-insensitive.
HREF_TOKEN = r"\b\w*href\w*\b"

# Missing-apostrophe repair, applied in order to the lower-cased text.
APOSTROPHE_FIXES = (
    (r"\b([a-z]+)\s+s\b", r"\1's"),
    (r"\bi\s+m\b", "i'm"),
    (r"\b(you|we|they|he|she|it|that|what|who|there)\s+re\b", r"\1're"),
    (r"\b(i|you|he|she|we|they|it|that|this|there|what|who)\s+ll\b", r"\1'll"),
    (r"\b(i|you|we|they|could|should|would|might|must)\s+ve\b", r"\1've"),
    (r"\b(i|you|he|she|we|they|it|that|there|what|who)\s+d\b", r"\1'd"),
    (r"\b(do|does|did|is|are|was|were|has|have|had|wo|ca|could|would|should|must|might|ought)n?\s+t\b", r"\1n't"),
)

# Slang table, applied in this order to the lower-cased text.  Note the key
# 'lomg' (not 'omg') is kept as is (decision Q2).
SLANG = (
    (r"\bb\s+c\b", "because"),
    (r"\bbc\b", "because"),
    (r"\bbcuz\b", "because"),
    (r"\bcuz\b", "because"),
    (r"\bcoz\b", "because"),
    (r"\bbcos\b", "because"),
    (r"\bpls\b", "please"),
    (r"\bplz\b", "please"),
    (r"\bthx\b", "thanks"),
    (r"\bthnx\b", "thanks"),
    (r"\bthanx\b", "thanks"),
    (r"\bidk\b", "i do not know"),
    (r"\bidgaf\b", "i do not care"),
    (r"\bic\b", "i see"),
    (r"\b2\b", "to"),
    (r"\b4\b", "for"),
    (r"\b8\b", "ate"),
    (r"\bb4\b", "before"),
    (r"\b2day\b", "today"),
    (r"\b2morrow\b", "tomorrow"),
    (r"\b2nite\b", "tonight"),
    (r"\blol\b", "laughing out loud"),
    (r"\blomg\b", "oh my god"),
    (r"\bomfg\b", "oh my god"),
    (r"\bwtf\b", "what the"),
    (r"\bbtw\b", "by the way"),
    (r"\bfyi\b", "for your information"),
    (r"\basap\b", "as soon as possible"),
    (r"\bimy\b", "i miss you"),
    (r"\bily\b", "i love you"),
    (r"\btbh\b", "to be honest"),
    (r"\bimo\b", "in my opinion"),
    (r"\bimho\b", "in my humble opinion"),
    (r"\bbrb\b", "be right back"),
    (r"\bafk\b", "away from keyboard"),
    (r"\bgtg\b", "got to go"),
    (r"\bg2g\b", "got to go"),
    (r"\bomw\b", "on my way"),
    (r"\bsmh\b", "shaking my head"),
    (r"\bwyd\b", "what are you doing"),
    (r"\bhbu\b", "how about you"),
    (r"\bnvm\b", "never mind"),
    (r"\bc\b", "see"),
    (r"\bu\b", "you"),
    (r"\bur\b", "your"),
    (r"\br\b", "are"),
    (r"\by\b", "why"),
    (r"\bn\b", "and"),
    (r"\bw\b", "with"),
    (r"\bwo\b", "without"),
)

# Display names of model families; unknown families are upper-cased.
FAMILY_DISPLAY = {"roberta": "RoBERTa", "electra": "ELECTRA", "deberta": "DeBERTa"}

# Name of the uncompressed baseline model in compression reports.
BASELINE_MODEL = "Full"

# ---------------------------------------------------------------------------
# Our own values (not taken from the reference)
# ---------------------------------------------------------------------------

# Contraction dictionary.  The reference delegates to a third-party package;
# this is our own list of ordinary English contractions, with and without
# the apostrophe.  Ambiguous plain words (ill, id, were, well, its, hell,
# shell, wed, cant's homograph aside) are deliberately absent.
CONTRACTIONS = {
    "ain't": "are not", "aren't": "are not", "arent": "are not",
    "can't": "cannot", "cant": "cannot", "can't've": "cannot have",
    "'cause": "because", "cause": "because",
    "could've": "could have", "couldve": "could have",
    "couldn't": "could not", "couldnt": "could not",
    "didn't": "did not", "didnt": "did not",
    "doesn't": "does not", "doesnt": "does not",
    "don't": "do not", "dont": "do not",
    "hadn't": "had not", "hadnt": "had not",
    "hasn't": "has not", "hasnt": "has not",
    "haven't": "have not", "havent": "have not",
    "he'd": "he would", "he'll": "he will", "he's": "he is",
    "how'd": "how did", "how'll": "how will", "how's": "how is",
    "i'd": "i would", "i'll": "i will", "i'm": "i am", "im": "i am",
    "i've": "i have", "ive": "i have",
    "isn't": "is not", "isnt": "is not",
    "it'd": "it would", "it'll": "it will", "it's": "it is",
    "let's": "let us",
    "ma'am": "madam",
    "mightn't": "might not", "might've": "might have",
    "mustn't": "must not", "mustnt": "must not", "must've": "must have",
    "needn't": "need not",
    "o'clock": "of the clock",
    "oughtn't": "ought not",
    "shan't": "shall not",
    "she'd": "she would", "she'll": "she will", "she's": "she is",
    "should've": "should have", "shouldve": "should have",
    "shouldn't": "should not", "shouldnt": "should not",
    "somebody's": "somebody is", "somebodys": "somebody is",
    "someone's": "someone is", "someones": "someone is",
    "that'd": "that would", "that's": "that is", "thats": "that is",
    "there'd": "there would", "there's": "there is", "theres": "there is",
    "they'd": "they would", "they'll": "they will", "they're": "they are",
    "theyre": "they are", "they've": "they have", "theyve": "they have",
    "wasn't": "was not", "wasnt": "was not",
    "we'd": "we would", "we'll": "we will", "we're": "we are", "we've": "we have",
    "weren't": "were not", "werent": "were not",
    "what'll": "what will", "what're": "what are", "what's": "what is",
    "whats": "what is", "what've": "what have",
    "when's": "when is", "where'd": "where did", "where's": "where is",
    "who'd": "who would", "who'll": "who will", "who's": "who is", "whos": "who is",
    "who've": "who have",
    "why's": "why is",
    "won't": "will not", "wont": "will not",
    "would've": "would have", "wouldve": "would have",
    "wouldn't": "would not", "wouldnt": "would not",
    "y'all": "you all",
    "you'd": "you would", "you'll": "you will", "you're": "you are",
    "youre": "you are", "you've": "you have", "youve": "you have",
    # forms of several parts
    "couldn't've": "could not have", "hadn't've": "had not have", "he'd've": "he would have",
    "i'd've": "i would have", "i'll've": "i will have", "it'd've": "it would have",
    "mightn't've": "might not have", "mustn't've": "must not have", "she'd've": "she would have",
    "shouldn't've": "should not have", "they'd've": "they would have", "we'd've": "we would have",
    "who'd've": "who would have", "won't've": "will not have", "wouldn't've": "would not have",
    "y'all're": "you all are", "y'all've": "you all have", "you'd've": "you would have",
    # informal forms
    "gimme": "give me", "gonna": "going to", "gotta": "got to", "kinda": "kind of", "lemme": "let me",
    "outta": "out of", "sorta": "sort of", "wanna": "want to",
}

# Model names of the derived prediction fixture, in order (our own).
FIXTURE_MODELS = ("alpha-small", "alpha-large", "beta-base", "Full", "step0", "step1")
