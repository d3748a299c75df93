"""``python -m larder ...`` runs the batch job (see ``larder.job``)."""

from larder.job import main

main()
