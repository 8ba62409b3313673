"""Training-data operators: packing, quality, dedup, search, sharding, mixing, rules, licenses, URLs, language.

Nothing outside this subpackage imports it. Functions that run inside Python
tasks live in modules of this package, so a cluster run ships the package with
``--py-files`` (or installs it).
"""
