"""Reading, writing, paging and expiring tables."""
