"""Report compositions (incidence, kitten, surgery, stay, wait, delayed, invoices) and registered queries."""
