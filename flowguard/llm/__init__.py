"""Training-data operators: near-duplicates, decontamination, mixing, extraction, classifiers,
language-model scores, repeated passages and chat formatting. Nothing else in the library
imports this subpackage."""
