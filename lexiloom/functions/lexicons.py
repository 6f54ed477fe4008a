"""Word lists, patterns and tables that results depend on. All of these are fixed values."""

# Topics in order of precedence, each with substrings of lower-cased text.
TOPICS = {
    "debugging": ["error", "bug", "traceback", "fix", "debug", "issue", "exception", "fail", "crash"],
    "architecture": ["design", "arch", "system", "framework", "structure", "pattern", "component"],
    "rcf_theory": ["rcf", "recursive", "categorical", "frame", "eigenrecursion", "hsgm", "urst"],
    "rlhf_impl": ["rlhf", "dpo", "ppo", "reward", "reinforcement", "training", "fine-tune"],
    "code_review": ["review", "refactor", "improve", "clean", "optimize", "format"],
    "data_processing": ["data", "pipeline", "etl", "load", "process", "csv", "json", "parquet"],
    "deployment": ["deploy", "docker", "container", "production", "serve", "kubernetes", "k8s"],
    "meta": ["discuss", "talk about", "explain", "understand", "what is", "how does"],
}

# Tones in order of precedence; without a hit the tone is neutral.
TONES = {
    "clinical": ["verify", "validation", "implementation", "requirement", "analysis", "evaluation"],
    "collaborative": ["let's", "together", "we can", "our approach", "partner"],
    "conversational": ["what if", "maybe", "i think", "perhaps", "wondering"],
    "code_driven": ["run the code", "terminal", "execute", "output", "```"],
    "debugging": ["failed", "error", "fix", "because", "traceback", "debug"],
}

# Signs of a correction and of sycophancy.
CORRECTIONS = ["no that's wrong", "let me rephrase", "actually", "i meant", "not quite", "revise", "rewrite", "change that", "fix this", "incorrect", "that's not right", "you misunderstood", "try again"]
SYCOPHANCY = ["i agree", "you're right", "absolutely", "exactly", "precisely", "great point", "excellent", "perfect", "wonderful idea"]

# Signs of boilerplate and of secrets.
BOILERPLATE = ["click here", "subscribe", "cookie policy", "terms of service", "privacy policy", "all rights reserved", "copyright", "disclaimer"]
RISK_WORDS = ["password", "secret", "confidential", "private key", "api key", "token", "credentials"]

# Patterns of personal data, in the order in which types are listed.
PII = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
    "ip_address": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
}

# Patterns of unsafe prompts by category, and what one match adds to the score.
INJECTION = [r"ignore\s+(?:previous|above|prior)", r"forget\s+(?:previous|above|prior)", r"disregard\s+(?:instructions|rules)", r"system\s*:\s*", r"user\s*:\s*.*assistant\s*:", r"\{\{.*?\}\}", r"<%.*?%>", r"\$\{.*?\}"]
JAILBREAK = [r"dan\s*(?:mode|prompt)", r"jailbreak", r"ignore\s+ethical", r"pretend\s+(?:to\s+be|you\s+are)", r"role\s*play", r"hypothetically", r"for\s+educational\s+purposes", r"research\s+purposes"]
EXFILTRATION = [r"send\s+(?:to|data).*?http", r"upload\s+to", r"base64\s+encode", r"encode\s+as", r"save\s+to\s+file"]
UNSAFE = {"injection": (INJECTION, 0.2), "jailbreak": (JAILBREAK, 0.3), "exfiltration": (EXFILTRATION, 0.25)}
#: Lower-cased words that a match of each category must hold: all words of one entry.
UNSAFE_WORDS = {
    "injection": [("ignore",), ("forget",), ("disregard",), ("system", ":"), ("user", "assistant"), ("{{",), ("<%",), ("${",)],
    "jailbreak": [("dan", "mode"), ("dan", "prompt"), ("jailbreak",), ("ignore", "ethical"), ("pretend",), ("role", "play"), ("hypothetically",), ("purposes",)],
    "exfiltration": [("send", "http"), ("upload",), ("base64",), ("encode", "as"), ("save", "file")],
}

# Patterns of artifacts in conversations.
TERMINAL = r"(?:>>>|\$|# Output:|Error:)"
MANIFEST = r"(?:kind:|apiVersion:|metadata:|spec:)"

# Context windows in tokens.
WINDOWS = {"4k": 4096, "8k": 8192, "32k": 32768, "128k": 131072}

# Dollars per million tokens (training, inference) by model family, and for others.
COSTS = {"gpt-3.5-turbo": (8.0, 0.5), "gpt-4": (30.0, 30.0), "llama-2-7b": (2.0, 0.2), "llama-2-13b": (4.0, 0.4), "llama-2-70b": (15.0, 2.0)}
COST_OTHER = (5.0, 1.0)

# Sources that a raw-only corpus must not name.
BANNED_SOURCES = ["documentation", "stackoverflow", "web_crawl", "github_code"]

# Signs of a correction in preference pairs, and the types of corrections in order of precedence.
PAIR_SIGNS = ["no that", "wrong", "let me", "actually", "i meant", "not quite", "revise", "rewrite", "change", "fix", "incorrect"]
PAIR_TYPES = {
    "syntax_error": ["syntax", "indentation", "bracket", "quote"],
    "logic_error": ["logic", "wrong", "incorrect", "error"],
    "incomplete": [],  # by length: the better answer has over one and a half times the characters
    "unclear": ["unclear", "confuse", "not clear"],
    "style": ["style", "cleaner", "better", "improve"],
}

# Model families with phrases that they use and the share of characters beyond ASCII.
FAMILIES = {
    "gpt-4o": (["I appreciate", "I'd be happy", "😊", "collaboratively"], 0.02, 0.1),
    "gpt-4.5": (["I'll", "structured", "step-by-step", "efficiency"], 0.0, 0.02),
    "gpt-5-class": (["Let me think", "reasoning", "deeper", "consider"], 0.0, 0.01),
}

# Signs that a user reports what running an artifact gave.
FEEDBACK = ["Error:", "Output:", ">>>", "Traceback"]

# Patterns of technical terms, each between word borders.
TERMS = ["[A-Z]{2,}[a-z]?[A-Z]?[a-z]*", "[a-z_]+_[a-z_]*", "[A-Z]{2,}"]

# Providers that are merged only on demand.
FILLER_PROVIDERS = ["deepseek", "qwen"]
