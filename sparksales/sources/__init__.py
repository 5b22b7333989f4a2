"""Reading the raw sales table and writing results."""

from .reader import parsing_report, read_sales_csv, rejected_cells, typed_sales
from .writer import write_result

__all__ = ["parsing_report", "read_sales_csv", "rejected_cells", "typed_sales", "write_result"]
