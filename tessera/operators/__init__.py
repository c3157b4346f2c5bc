"""DataFrame operators: prompts, records, judging, resume, routing, statistics."""
