"""Every literal that decides a result, stated once, as plain text.

Operators take these as defaults. Callers with another domain pass their own
keyword lists, denylists and texts; nothing else in the package repeats them.
"""

from __future__ import annotations

# --- fixed values: markers and end token -----------------------------------
HUMAN = "### Human:"
ASSISTANT = "### Assistant:"
END_TOKEN = "<|endoftext|>"
END_TOKEN_ID = 50256
UNKNOWN_ID = 0

# --- fixed values: whitespace as str.isspace() defines it -------------------
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = r"(?U:[\s\x1c-\x1f])"
NO_SPACE_OR_COMMA = r"(?U:[^,\s\x1c-\x1f])"

# --- fixed values: generation prompts ---------------------------------------
SYSTEM_PROMPT = "You are a helpful assistant specialized in creating educational Q&A content."
GENERATION_PROMPT = """
    You are a senior JVM performance engineer creating high-quality training data. Based on the technical content below, create ONE comprehensive question-answer pair.

    Content: {text}

    STRICT Requirements:
    1. Question must be specific, realistic, and commonly asked by developers
    2. Answer must be technically accurate with NO fabricated information
    3. Use ONLY real JVM tools: jstat, jmap, jconsole, VisualVM, JProfiler, Eclipse MAT, GCViewer
    4. Use ONLY real JVM parameters: -Xmx, -Xms, -XX:NewRatio, -XX:MaxMetaspaceSize, -XX:+UseG1GC, etc.
    5. Provide complete, actionable solutions with specific commands
    6. Answer must be 150-300 characters for comprehensive coverage
    7. Include practical examples with realistic values
    8. Use EXACTLY this format:

    ### Human:
    [Specific, realistic question]
    ### Assistant:
    [Complete, accurate answer with examples and commands]

    GOOD Example:
    ### Human:
    How do I identify memory leaks in a Java application?
    ### Assistant:
    To identify memory leaks: 1) Use jmap -histo <pid> to see object counts over time, 2) Generate heap dumps with jmap -dump:format=b,file=heap.hprof <pid>, 3) Analyze with Eclipse MAT or VisualVM to find objects not being garbage collected, 4) Look for growing collections or static references, 5) Monitor with -XX:+PrintGCDetails to see if heap usage keeps increasing after GC.

    BAD Examples to AVOID:
    - Fake tools: "AnalyzingGarbage collected Logs", "JVMProfiler Pro"
    - Fake parameters: "tuned ForThreadExecutionPatterns", "-XX:CustomMemoryTuning"
    - Fake experts: "urologist David Carr", "Dr. Smith recommends"
    - Incomplete answers: "Use jstat to check" (too short)
    """
RETRY_PREFIX = "\n\nIMPORTANT: Avoid these issues: "
RETRY_SUFFIX = (
    ". Provide a detailed, accurate answer with real JVM tools and at least 150 characters."
)
FALLBACK_SAMPLE = (
    "### Human: What is JVM?\n### Assistant: JVM stands for Java Virtual Machine."
)

# --- fixed values: cleaner rewrites, in order -------------------------------
# (pattern, replacement); {ws} is whitespace, {name} neither whitespace nor a comma
TECHNICAL_REWRITES = (
    (r"-XX:\+Use{ws}+java/heap-gc=", "-XX:+UseG1GC"),
    (r"-Xmx(\p{Nd}+)([^g|m])", "-Xmx$1g"),
    (r"-Xms(\p{Nd}+)([^g|m])", "-Xms$1m"),
    (r"jstack{ws}+<pid>", "jstack <pid>"),
    (r"jmap{ws}+-dump[^,]*,file=({name}+)", "jmap -dump:format=b,file=$1.hprof"),
    (r"{ws}+", " "),
    (r"([.!?]){ws}*([a-z])", "$1 $2"),
)
TECHNICAL_WORDS = ("-XX:+Use", "-Xmx", "-Xms", "jstack", "jmap")
ANSWER_DELETIONS = ("---", "**", ")", "(")
ANSWER_ARTIFACTS = ("###", "**", "---", "```", "`", "\n\n", "\t")
SENTENCE_ENDS = (".", "!", "?")

# --- fixed values: quality vocabulary ---------------------------------------
GATE_EXPERTS = ("urologist David Carr", "Dr. Smith")
GATE_TOOLS = ("tuned ForThreadExecutionPatterns", "AnalyzingGarbage collected Logs")
GATE_KEYWORDS = ("jstat", "jmap", "jconsole", "visualvm", "gc", "heap", "memory")
REPORT_EXPERTS = ("urologist David Carr", "Dr. Smith", "Professor Johnson")
REPORT_TOOLS = (
    "tuned ForThreadExecutionPatterns",
    "AnalyzingGarbage collected Logs",
    "JVMProfiler Pro",
)
REPORT_KEYWORDS = ("jstat", "jmap", "jconsole", "visualvm", "gc", "heap", "memory", "jvm")
FAKE_EXPERT = ("urologist David Carr",)
FAKE_PARAMETER = ("tuned ForThreadExecutionPatterns",)
FAKE_TOOL = ("AnalyzingGarbage collected Logs",)

# --- fixed values: flag wording ---------------------------------------------
GATE_FLAGS = (
    "too short",
    "fake expert names",
    "fake tools/parameters",
    "missing JVM tools/concepts",
)
FLAG_EXPERT = "Contains fake expert name"
FLAG_PARAMETER = "Contains fake JVM parameter"
FLAG_TOOL = "Contains fake tool name"
FLAG_TOOL_OR_PARAMETER = "Contains fake tool/parameter"
FLAG_NO_KEYWORD = "Missing JVM technical content"
FLAG_MULTIPLE = "Multiple Q&A pairs in single sample"

# --- fixed values: answers shown when cleaning leaves nothing ----------------
CHAT_NOTHING_KEPT = (
    "I need more context to provide a helpful answer. Could you rephrase your question?"
)
CHAT_EMPTY = "I'm having trouble generating a response. Could you try asking differently?"
ERROR_STARTS = ("Error", "Failed", "Cannot")

# --- fixed values: message classes, first match wins on lower-cased text ----
ERROR_CLASSES = {
    "generation": (("memory", ("out of memory",)), ("token", ("token",))),
    "fetch": (
        ("not_found", ("404", "not found")),
        ("auth", ("401", "403")),
        ("network", ("network", "connection")),
    ),
    "publish": (
        ("auth", ("401", "unauthorized")),
        ("not_found", ("404", "not found")),
        ("permission", ("403", "forbidden")),
    ),
    "connect": (
        ("auth", ("401", "unauthorized")),
        ("permission", ("403", "forbidden")),
        ("network", ("network", "connection")),
    ),
    "training": (("memory", ("out of memory",)),),
}

# --- fixed values: question suites ------------------------------------------
CORE_QUESTIONS = (
    "What are common JVM memory issues?",
    "How do I troubleshoot OutOfMemoryError?",
    "What JVM parameters should I tune for performance?",
    "How do I analyze garbage collection logs?",
    "What causes high CPU usage in JVM applications?",
)
EXTENDED_QUESTIONS = CORE_QUESTIONS + (
    "How do I debug memory leaks in Java applications?",
    "What are the best practices for JVM monitoring?",
    "How do I optimize JVM startup time?",
    "What tools can I use for JVM profiling?",
    "How do I handle StackOverflowError?",
    "What are the differences between heap and non-heap memory?",
)

# --- fixed values: rule tables ----------------------------------------------
# (class, lo, hi or None, option, risk)
EPOCH_RULES = (
    ("small", 0, 100, 3, "Low overfitting risk"),
    ("small", 100, None, 2, "Medium overfitting risk with large dataset"),
    ("medium", 0, 150, 4, "Low overfitting risk"),
    ("medium", 150, 300, 3, "Balanced learning"),
    ("medium", 300, None, 2, "Large dataset - fewer epochs needed"),
    ("large", 0, 200, 2, "Small dataset - risk of overfitting"),
    ("large", 200, 400, 3, "Good balance"),
    ("large", 400, None, 4, "Large dataset - can handle more epochs"),
)
EPOCH_OPTIONS = (3, 6, 8, 10, 12)
# class -> (recommended option, optimal examples lo, hi); unknown names use "medium"
SIZE_RULES = (
    ("small", 2, 50, 200),
    ("medium", 3, 100, 400),
    ("large", 4, 300, 800),
)
SIZE_OPTIONS = (50, 100, 200, 500, 800)
# (name, base model, examples, epochs, method, minimum GPU memory in GB or None)
PRESETS = (
    ("premium_gpu", "microsoft/DialoGPT-large", 500, 10, "full", 8),
    ("balanced_gpu", "microsoft/DialoGPT-medium", 200, 8, "full", 4),
    ("fast_gpu", "microsoft/DialoGPT-small", 100, 6, "full", 0),
    ("efficient_lora", "microsoft/DialoGPT-medium", 300, 8, "lora", 0),
    ("cpu_optimized", "microsoft/DialoGPT-small", 100, 4, "lora", None),
)

# --- fixed values: file manifests -------------------------------------------
RECOVERY_REQUIRED = (
    "config.json",
    "generation_config.json",
    "tokenizer.json",
    "tokenizer_config.json",
    "vocab.json",
    "merges.txt",
    "special_tokens_map.json",
)
RECOVERY_ANY_OF = ("model.safetensors", "pytorch_model.bin", "adapter_model.safetensors")
DOWNLOAD_REQUIRED = ("config.json", "tokenizer_config.json")
DOWNLOAD_ANY_OF = ("model.safetensors", "pytorch_model.bin")

# --- fixed values: card placeholders, in replacement order -------------------
CARD_PLACEHOLDERS = (
    "base_model",
    "model_size",
    "vocab_size",
    "finetune_method",
    "training_regime",
    "training_description",
    "ai_provider",
    "train_size",
    "test_size",
    "total_size",
    "learning_rate",
    "batch_size",
    "num_epochs",
    "warmup_steps",
    "training_time",
    "accuracy",
    "perplexity",
)
NOT_EVALUATED = "Not evaluated"
REGIME_LORA = "LoRA (Low-Rank Adaptation)"
REGIME_FULL = "Full fine-tuning"
DESCRIPTION_LORA = "Parameter-efficient fine-tuning using LoRA adapters"
DESCRIPTION_FULL = "Complete model parameter fine-tuning"
