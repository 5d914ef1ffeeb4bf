"""Column expressions: text cleaning, prompts, tokens and per-row scores."""
