"""The tables of each layer, the reports over them, and the runs that build them."""
