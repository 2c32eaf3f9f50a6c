"""Reading the shop tables and writing results."""
