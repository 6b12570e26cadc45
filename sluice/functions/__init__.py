"""Column functions shared by the operators."""

from sluice.functions.columns import list_text, named, parse_list, quoted, title_case, upper_case

__all__ = ["list_text", "named", "parse_list", "quoted", "title_case", "upper_case"]
