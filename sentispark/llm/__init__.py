"""Training-data operators: duplicates, languages, pages, packing, chat, toxicity, mixing and vectors."""
