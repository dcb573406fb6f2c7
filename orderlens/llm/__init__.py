"""Training-data operators: text quality, toxicity, licences, URLs, HTML, de-duplication,
decontamination and packing. Nothing else in the package imports this subpackage."""
