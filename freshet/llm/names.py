"""Given names that mark a name without a form of address, by gender; 'n' serves both.

Left out on purpose: names that are mostly other words or places before a capital
(Will, May, April, June, Paris, Virginia, Austin, Florence, Georgia, Sydney, Chelsea, Dallas).
"""

KNOWN = {
    "m": """
Aaron Abdul Abdullah Abel Abraham Adam Adrian Ahmad Ahmed Aidan Alan Albert Alberto Alejandro Alessandro Alex Alexander Alfonso Alfred Ali Allan
Allen Alvin Amir Anders Andre Andrea Andreas Andrés Andrew Andy Angelo Angus Anthony Antoine Anton Antonio Arjun Arnold Arthur Arturo Arun Ashok
Barry Bartholomew Ben Benedict Benjamin Bernard Bernd Bernhard Bill Björn Bob Bobby Boris Brad Bradley Brandon Brendan Brent Brett Brian Bruce Bruno Bryan Byron
Caleb Calvin Cameron Carl Carlo Carlos Cecil Cedric Charles Charlie Chen Chris Christian Christoph Christopher Claude Claudio Clifford Clive Colin Connor Craig Cristian Curtis
Damien Dan Daniel Danny Darius Darren Dave David Dean Deepak Dennis Derek Detlef Diego Dieter Dimitri Dirk Dmitri Dominic Dominik Donald Douglas Duncan Dustin Dylan
Earl Eddie Edgar Eduardo Edward Edwin Elias Elijah Elliot Emil Emilio Emmanuel Enrique Eric Erik Ernest Ernesto Ethan Étienne Eugene Evan
Fabian Fabio Felipe Felix Ferdinand Fernando Filip Florian Francesco Francis Francisco François Frank Franz Fred Frederick Friedrich Fritz
Gabriel Gareth Gary Gavin Geoffrey George Georg Gerald Gerard Gerhard Gilbert Giovanni Giuseppe Glenn Gordon Graham Greg Gregory Guido Guillermo Günter Gustav Guy
Hans Harald Harold Harry Harvey Hassan Hector Heinrich Heinz Helmut Henri Henrik Henry Herbert Herman Hermann Hiroshi Horst Howard Hugh Hugo Hussein
Ian Ibrahim Ignacio Igor Ingo Isaac Isaiah Ismail Ivan Jack Jackson Jacob Jacques Jaime Jake Jakob Jamal James Jan Jared Jason Javier Jay Jean Jeff Jeffrey
Jens Jeremiah Jeremy Jerome Jerry Jesse Jesús Jim Jimmy Joachim Joe Joel Johan Johannes John Johnny Jon Jonas Jonathan Jorge José Josef Joseph Joshua Josh Juan Julian Julio Jürgen Justin
Karl Keith Kenneth Kenji Kevin Khalid Klaus Konrad Kumar Kurt Kyle Lars Larry Laurent Lawrence Lee Leo Leon Leonard Leonardo Leroy Leslie Lewis Liam Lionel Logan Lorenzo Louis Luca Lucas Luigi Luis Lukas Luke Luther
Magnus Malcolm Manfred Manuel Marc Marcel Marco Marcus Mario Marius Mark Markus Martin Marvin Mateo Matteo Matthew Matthias Maurice Max Maximilian Mehmet Melvin Michael Michel Miguel Mike Milan Mitchell Mohamed Mohammad Mohammed Moritz Moses Muhammad Mustafa
Nathan Nathaniel Neil Nicholas Nick Nicolas Niels Nigel Nikolai Nils Noah Noel Norbert Norman Oleg Oliver Olivier Omar Oscar Oskar Otto Owen
Pablo Paolo Pascal Patrick Paul Pavel Pedro Per Peter Petr Phil Philip Philippe Phillip Pierre Pietro Prakash Quentin
Rafael Rainer Raj Rajesh Ralf Ralph Ramón Randall Randy Raphael Raúl Ravi Ray Raymond Reinhard René Ricardo Richard Rick Robert Roberto Rodney Rodrigo Roger Roland Rolf Roman Ronald Ron Ross Roy Rudolf Rüdiger Russell Ryan
Salvador Sam Samir Samuel Sanjay Santiago Scott Sean Sebastian Sergei Sergio Seth Shane Shaun Siegfried Simon Stanley Stefan Stephan Stephen Steve Steven Stewart Stuart Sven
Takashi Ted Terence Terry Theodore Thomas Thorsten Tim Timothy Tobias Todd Tom Tomás Tommy Tony Travis Trevor Tyler Udo Ulrich Uwe
Vernon Victor Vijay Vincent Vincenzo Vladimir Volker Wallace Walter Warren Wayne Wei Werner Wilhelm William Willie Wolfgang Xavier Yusuf Yves Zachary Zoltan
""",
    "f": """
Abigail Ada Adele Adriana Agatha Agnes Aisha Alexandra Alexis Alice Alicia Alison Allison Amanda Amber Amelia Amina Amy Ana Anastasia Angela Angelica Angelina Anita Anja Anke Ann Anna Anne Annette Annie Antonia Ariana Astrid Audrey
Barbara Beate Beatrice Beatriz Becky Bernadette Bertha Beth Bethany Betty Beverly Birgit Bonnie Brenda Brianna Bridget Brigitte Brittany
Camila Camille Carla Carmen Carol Carole Carolina Caroline Carolyn Carrie Cassandra Catalina Catherine Cathy Cecilia Céline Charlotte Cheryl Chiara Chloe Christa Christiane Christina Christine Cindy Claire Clara Claudia Colleen Connie Constance Cornelia Courtney Crystal Cynthia
Dana Danielle Daphne Deborah Debbie Debra Denise Diana Diane Dolores Donna Doris Dorothea Dorothy Edith Eileen Elaine Eleanor Elena Elisa Elisabeth Elizabeth Elke Ella Ellen Elsa Elsie Emilia Emily Emma Erica Erika Erin Esther Ethel Eva Evelyn
Fatima Felicia Fiona Frances Francesca Franziska Frida Gabriela Gabriele Gabrielle Gail Genevieve Geraldine Gertrude Gina Giulia Gisela Gladys Gloria Grace Greta Gudrun Gwendolyn
Hannah Hanna Harriet Heather Heidi Heike Helen Helena Helga Hélène Henrietta Hilary Hilda Ida Ilse Inés Inga Ingrid Irene Irina Iris Irma Isabel Isabella Isabelle
Jacqueline Jade Jana Jane Janet Janice Janine Jasmine Jeanne Jeannette Jenna Jennifer Jenny Jessica Jill Joan Joanna Joanne Jocelyn Johanna Josephine Joyce Juana Judith Judy Julia Juliana Julie Juliette Jutta
Kaitlyn Karen Karin Karina Kate Katharina Katherine Kathleen Kathryn Kathy Katie Katja Katrin Kayla Kelly Kerstin Kimberly Kirsten Kristen Kristin Kristina
Lara Larissa Laura Lauren Layla Lea Leah Leila Lena Leonora Leticia Lillian Linda Lisa Lois Lorena Loretta Lori Lorraine Louise Lucia Lucille Lucy Luisa Lydia Lynn
Mabel Madeleine Madison Magdalena Maike Manon Manuela Marcia Margaret Margarita Margot Maria María Mariana Marianne Marie Marilyn Marina Marion Marjorie Marlene Marta Martha Martina Mary Matilda Maureen Maya Megan Mei Melanie Melissa Mercedes Meredith Mia Michelle Mildred Miriam Molly Mónica Monica Monika Muriel
Nadia Nadine Nancy Naomi Natalia Natalie Natasha Nicole Nina Noemi Nora Norma Olga Olivia Ortrud Pamela Patricia Paula Pauline Peggy Penelope Petra Phyllis Pilar Priscilla Priya
Rachel Ramona Raquel Rebecca Regina Renate Renee Rhonda Rita Roberta Rocío Rosa Rosalind Rosario Rose Rosemary Roxanne Ruth
Sabine Sabrina Sally Samantha Sandra Sara Sarah Selma Sharon Sheila Shirley Sigrid Silvia Simone Sofia Sonia Sophia Sophie Stacy Stella Stephanie Sue Susan Susanna Susanne Suzanne Svetlana Sylvia
Tamara Tammy Tanya Tara Tatiana Teresa Tess Theresa Thelma Tiffany Tina Tracy Trudy Ulrike Ursula Ute Valentina Valeria Valerie Vanessa Vera Veronica Véronique Vicki Victoria Vivian Wanda Wendy Wilma Yolanda Yuki Yvonne Zoe
""",
    "n": "Jamie Kim Alexis Ashley Drew Hayden Jessie Lindsay Pat Shannon Shelby Sasha Skyler Stacey",
}
KNOWN_CYRILLIC = {
    "m": """
Александр Алексей Анатолий Андрей Антон Аркадий Артём Богдан Борис Вадим Валентин Валерий Василий Виктор Виталий Владимир Владислав Вячеслав Геннадий Георгий Григорий
Даниил Денис Дмитрий Евгений Егор Иван Игорь Илья Кирилл Константин Лев Леонид Максим Матвей Михаил Никита Николай Олег Павел Пётр Роман Руслан Сергей Станислав Степан Тимофей Фёдор Юрий Ярослав
""",
    "f": """
Александра Алина Алла Анастасия Ангелина Анна Валентина Валерия Варвара Василиса Вероника Виктория Галина Дарья Диана Евгения Екатерина Елена Елизавета Жанна Зинаида Зоя Инна Ирина
Карина Ксения Лариса Лидия Любовь Людмила Маргарита Марина Мария Надежда Наталия Наталья Нина Оксана Ольга Полина Раиса Светлана София Тамара Татьяна Ульяна Юлия Яна
""",
    "n": "Женя Саша Валя Слава Шура",
}
